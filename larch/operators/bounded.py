"""k-means rounds that move only what changed.

Every entity carries two bounds: no more than ``upper`` to its own centroid, no less
than ``lower`` to any other.  A centroid's move changes them by its length (triangle
inequality), and an entity whose bounds stay apart keeps its cluster unread.  Only the
cells of the others meet the weights, and only the cells of entities that changed
clusters change the weights.  Distances and ties are those of
:mod:`larch.operators.clusters`, so the assignment is the same.

A round is one job.  It writes one table, which cuts the lineage, with the entities'
state and the next weights; the sums it needs are observed on the way, so no table is
read for them.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from larch.operators import clusters
from larch.session import stored

#: Bounds closer than this share of them are not told apart.
SLACK = 1e-9
_STATE = ("entity", "_ns", "before", "cluster", "upper", "lower")


@dataclass
class Means:
    """The stored table of a round, and its centroids in whole numbers."""

    table: DataFrame            # rows of _STATE, and where _w: feature, _size, w0.., o0..
    members: list[int]
    sizes: list[int]            # of the centroid: a cluster without members keeps the one before
    sq: list[int]
    moves: list[float]          # how far each centroid moved last
    mark: tuple                 # equal for equal members' features
    drop: Callable[[], None]
    moved: int = 0              # entities that changed clusters
    rounds: int = field(default=0)

    def weights(self) -> DataFrame:
        """``(feature, _size, m.., w..)``: members with the feature, and the weights of
        the centroid, which an empty cluster has from before."""
        k = range(len(self.members))
        return self.table.where("_w").selectExpr(
            "feature", "_size", *[f"w{c} AS m{c}" for c in k],
            *[f"{'w' if self.members[c] else 'o'}{c} AS w{c}" for c in k])

    def state(self) -> DataFrame:
        return self.table.where("NOT _w").select(*_STATE)


def _array(values: list[float]) -> str:
    """A constant array.  Spark compiles equal code for it whatever it holds, so the
    rounds share their compiled stages."""
    return "array(" + ", ".join(
        "double('Infinity')" if math.isinf(v) else f"double('{float(v)!r}')" for v in values) + ")"


def _nearest(per_entity: DataFrame, means: Means) -> DataFrame:
    """State rows from ``entity, _ns, before, _nx, _d0..``: the nearest centroid, ties to
    the lowest, and bounds equal to the distances."""
    dots = ", ".join(f"double(_d{c})" for c in range(len(means.sizes)))
    ranked = (f"array_sort(transform(zip_with(array({dots}), {_zipped(means)}, "
              "(d, s) -> double(_nx) - (2.0D * d) / s.m + s.q / (s.m * s.m)), "
              "(d, c) -> struct(d, c)))")
    return per_entity.selectExpr("entity", "_ns", "before", f"{ranked} AS _r").selectExpr(
        "entity", "_ns", "before", "_r[0].c AS cluster", "sqrt(greatest(0.0D, _r[0].d)) AS upper",
        "coalesce(sqrt(greatest(0.0D, get(_r, 1).d)), double('Infinity')) AS lower")


def _zipped(means: Means) -> str:
    return f"zip_with({_array(means.sizes)}, {_array(means.sq)}, (m, q) -> struct(m, q))"


def _dots(k: int) -> list:
    return [F.expr(f"coalesce(sum(w{c}), 0L) AS _d{c}") for c in range(k)]


def first_state(layout: clusters.Layout, means: Means) -> DataFrame:
    """All entities with their nearest centroid."""
    k = len(means.sizes)
    weights = means.weights().where("NOT _size").select("feature", *[f"w{c}" for c in range(k)])
    per_entity = (layout.by_entity.where("NOT _size").join(weights, "feature", "left")
                  .groupBy("entity").agg(F.expr("count(1) AS _nx"), *_dots(k)))
    return _nearest(per_entity.join(layout.entity_salts, "entity").withColumn("before", F.lit(-1)), means)


def _of(layout: clusters.Layout, entities: DataFrame) -> DataFrame:
    """The cells of some entities (with ``_ns``); the cells stay in place."""
    salted = entities.withColumn("_salt", F.expr("explode(sequence(0, _ns - 1))"))
    return layout.by_entity.join(salted, ["entity", "_salt"])


def next_state(layout: clusters.Layout, means: Means) -> DataFrame:
    """The state after the centroids' last moves.  Entities whose bounds have met are
    compared with all centroids, the others keep their cluster."""
    k = len(means.sizes)
    others = [max([m for o, m in enumerate(means.moves) if o != c], default=0.0) for c in range(k)]
    kept = means.state().selectExpr(
        "entity", "_ns", "cluster AS before", "cluster",
        f"upper + element_at({_array(means.moves)}, cluster + 1) AS upper",
        f"lower - element_at({_array(others)}, cluster + 1) AS lower")
    met = f"upper * {1 + SLACK!r}D + {SLACK!r}D >= lower"
    weights = means.weights().where("NOT _size").select("feature", *[f"w{c}" for c in range(k)])
    cells = _of(layout, kept.where(met).select("entity", "_ns", "before")).where("NOT _size")
    per_entity = (cells.select("entity", "_ns", "before", "feature").join(weights, "feature", "left")
                  .groupBy("entity").agg(F.expr("max(_ns) AS _ns"), F.expr("max(before) AS before"),
                                         F.expr("count(1) AS _nx"), *_dots(k)))
    return kept.where(f"NOT ({met})").unionByName(_nearest(per_entity, means))


def _new_weights(layout: clusters.Layout, state: DataFrame, means: Means) -> DataFrame:
    """``(feature, _size, w.., o..)`` after the entities that changed clusters have
    moved: only their cells become partial sums."""
    k = range(len(means.sizes))
    changed = _of(layout, state.where("cluster <> before").select("entity", "_ns", "before", "cluster"))
    deltas = changed.selectExpr(
        "feature", "_size", *[f"bigint(cluster = {c}) - bigint(before = {c}) AS w{c}" for c in k],
        *[f"0L AS o{c}" for c in k])
    old = means.weights().selectExpr(
        "feature", "_size", *[f"m{c} AS w{c}" for c in k], *[f"w{c} AS o{c}" for c in k])
    return old.unionAll(deltas).groupBy("feature", "_size").agg(
        *[F.expr(f"sum({x}{c}) AS {x}{c}") for x in "wo" for c in k])


def next_means(layout: clusters.Layout, means: Means) -> Means:
    """One round: the entities' state by the present centroids, and the centroids
    after it.  A cluster without members keeps its centroid."""
    k = range(len(means.sizes))
    state = next_state(layout, means) if means.rounds else first_state(layout, means)
    state = state.select(*_STATE)
    weights = _new_weights(layout, state, means)
    inner = "sum(CASE WHEN NOT _size THEN {} END)"
    sums = [F.expr("count(1) AS rows"),
            F.expr(f"sum(CAST(xxhash64(feature, {', '.join(f'w{c}' for c in k)}) AS decimal(38,0))) AS mark")]
    for c in k:
        sums += [F.expr(f"max(CASE WHEN _size THEN w{c} END) AS m{c}"),
                 F.expr(f"{inner.format(f'w{c} * w{c}')} AS q{c}"), F.expr(f"{inner.format(f'w{c} * o{c}')} AS x{c}")]
    counted, summed = Observation(), Observation()
    both = (state.observe(counted, F.expr("count_if(cluster <> before) AS moved"))
            .withColumn("_w", F.lit(False))
            .unionByName(weights.observe(summed, *sums).withColumn("_w", F.lit(True)), allowMissingColumns=True))
    table, drop = stored(both)
    moved, row = counted.get["moved"], summed.get
    members, sizes, sq, moves = [], [], [], []
    for c in k:
        m, n, squares = int(row[f"m{c}"] or 0), means.sizes[c], means.sq[c]
        members.append(m)
        sizes.append(m or n)
        sq.append(int(row[f"q{c}"] or 0) if m else squares)
        # The squared move is a whole number over (m * n)^2.
        parts = sq[c] * n * n - 2 * int(row[f"x{c}"] or 0) * m * n + squares * m * m if m else 0
        moves.append(math.sqrt(max(0, parts)) / (sizes[c] * n) * (1 + SLACK))
    return Means(table, members, sizes, sq, moves, (row["rows"], row["mark"]), drop, moved, means.rounds + 1)


def first_means(layout: clusters.Layout, init: DataFrame, k: int) -> Means:
    """Centroids at the chosen entities; no entity has a state yet."""
    weights = clusters.cluster_weights(layout, init, k).selectExpr(
        "feature", "_size", "true AS _w", *[f"0L AS w{c}" for c in range(k)],
        *[f"w{c} AS o{c}" for c in range(k)])
    seen = Observation()
    table, drop = stored(weights.observe(seen, *[
        F.expr(f"sum(CASE WHEN NOT _size THEN o{c} * o{c} END) AS q{c}") for c in range(k)]))
    row = seen.get
    return Means(table, [0] * k, [1] * k, [int(row[f"q{c}"] or 0) for c in range(k)], [0.0] * k, (), drop)


def converged(layout: clusters.Layout, init: DataFrame, k: int) -> tuple[DataFrame, int, Callable[[], None]]:
    """``((entity, cluster), rounds, drop)``: rounds from the chosen entities until no
    entity changes clusters.  Superseded tables are deleted.  Members' features that come
    back after having changed would mean a cycle, which is an error."""
    means, seen = first_means(layout, init, k), set()
    while True:
        after = next_means(layout, means)
        means.drop()
        if after.moved and after.mark in seen and after.mark != means.mark:
            raise RuntimeError("k-means came back to an earlier state: it cycles")
        seen.add(after.mark)
        means = after
        if not means.moved:
            return means.state().select("entity", "cluster"), means.rounds, means.drop
