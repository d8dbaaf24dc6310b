"""k-means (Lloyd) over sparse 0/1 membership, from seeded centroids.

A centroid is kept as integer statistics, never as a dense vector: for
cluster c with m_c members, ``w_c[f]`` = members holding feature f and
``sq_c = sum_f w_c[f]^2``.  The squared distance of entity x (|x|
features) to the centroid ``w_c / m_c`` is

    |x| - 2 * dot / m_c + sq_c / m_c^2,   dot = sum_{f in x} w_c[f]

with integer ``dot`` and ``sq``, so the double result does not depend on
summation order.  Ties go to the lowest cluster index.

The cells are laid out twice, by ``(entity, salt)`` and by ``(feature,
salt)``.  The assignment pass joins the second layout with the weights and
the update pass the first with the assignment, each expanded over the salts
of its key: neither pass moves the cells.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larch.functions import seeded_key
from larch.session import stored, tasks_for

#: Cells of one task.  The number of tasks follows the cells; small tables get
#: as many tasks as there are cores, of this many cells at least.
CELLS_PER_TASK = 1_000_000
LEAST_CELLS = 50_000


def init_centroids(cells: DataFrame, k: int, seed: int,
                   candidates: DataFrame | None = None) -> DataFrame:
    """``(cluster, entity)``: the k entities first in ``md5(seed:entity)``
    order (then entity), numbered 0..k-1 in that order.

    ``candidates`` (a column ``entity``, e.g. a fixed list of codes)
    restricts the choice with a left-semi join; the order of the list does
    not matter.
    """
    order = [seeded_key(seed, "entity"), F.col("entity")]
    pool = cells.select("entity").distinct()
    if candidates is not None:
        pool = pool.join(candidates.select("entity"), "entity", "left_semi")
    chosen = pool.orderBy(*order).limit(k)
    # The window sees only the k chosen rows.
    return chosen.select((F.row_number().over(Window.orderBy(*order)) - 1).alias("cluster"),
                         "entity")


@dataclass
class Centroids:
    weights: DataFrame          # (feature, w0 .. w{k-1}), stored
    sizes: list[int]            # m_c
    sq: list[int]               # sq_c
    mark: tuple                 # equal for equal weights and sizes
    drop: Callable[[], None]


@dataclass
class Layout:
    """The cells in both layouts, and the salts of entities and features."""

    by_entity: DataFrame        # (entity, feature, _salt, _size), cached
    by_feature: DataFrame | None    # (entity, feature, _salt), cached
    entity_salts: DataFrame     # (entity, _ns), cached
    feature_salts: DataFrame | None

    def release(self) -> None:
        for df in (self.by_entity, self.by_feature, self.entity_salts, self.feature_salts):
            if df is not None:
                df.unpersist()


def _weight_cols(k: int) -> list[str]:
    return [f"w{c}" for c in range(k)]


def _laid_out(cells: DataFrame, key: str, other: str, tasks: int, total: int):
    """The cells cached by ``(key, _salt)`` and the salts of each key: a key
    gets ``ceil(its cells * tasks / all cells)`` salts, so one holding a third
    of the cells is spread over a third of the tasks.  Keys with more than one
    salt are fewer than ``tasks``: that table is broadcast with a proven bound.
    """
    salts = cells.groupBy(key).agg(F.count(F.lit(1)).alias("_deg")).select(key, F.greatest(
        F.lit(1), F.ceil(F.col("_deg") * tasks / total).cast("int")).alias("_ns")).persist()
    hot = salts.where(F.col("_ns") > 1)
    rows = (cells.join(F.broadcast(hot), key, "left")
            .withColumn("_ns", F.coalesce(F.col("_ns"), F.lit(1)))
            .select("entity", "feature", F.pmod(F.xxhash64(other), F.col("_ns")).cast("int").alias("_salt")))
    if key == "entity":
        # One more row per entity counts it once, whatever features it has.
        once = salts.select("entity", F.lit(None).cast(cells.schema["feature"].dataType).alias("feature"),
                            F.lit(0).alias("_salt"), F.lit(True).alias("_size"))
        rows = rows.withColumn("_size", F.lit(False)).unionByName(once)
    # A cached layout is used as it is: the numbers of its partitions stay.
    out = rows.repartition(tasks, key, "_salt").sortWithinPartitions(key, "_salt").persist()
    out.count()
    return out, salts


def lay_out(cells: DataFrame, cells_per_task: int = CELLS_PER_TASK, both: bool = True) -> Layout:
    """The cells by entity and, for ``both``, by feature.  The caller's frame is read and
    left alone; a lost cached block is computed again from the lineage."""
    cells = cells.select("entity", "feature")
    total = cells.count()
    cores = cells.sparkSession.sparkContext.defaultParallelism
    # Two at least: Spark does not join on the layout of a single partition.
    tasks = max(2, tasks_for(total, cells_per_task), min(cores, tasks_for(total, LEAST_CELLS)))
    by_entity, entity_salts = _laid_out(cells, "entity", "feature", tasks, max(1, total))
    if not both:
        return Layout(by_entity, None, entity_salts, None)
    by_feature, feature_salts = _laid_out(cells, "feature", "entity", tasks, max(1, total))
    return Layout(by_entity, by_feature, entity_salts, feature_salts)


def _salted(rows: DataFrame, salts: DataFrame, key: str) -> DataFrame:
    return rows.join(salts, key).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.col("_ns") - 1))).drop("_ns")


def cluster_weights(layout: Layout, assignment: DataFrame, k: int) -> DataFrame:
    """``(feature, w0..w{k-1}, _size)``: members of each cluster holding the
    feature, and one more row (``_size`` true) with the cluster sizes.  Only the
    assignment and partial sums per feature move."""
    moved = _salted(assignment.select("entity", "cluster"), layout.entity_salts, "entity")
    return layout.by_entity.join(moved, ["entity", "_salt"]).groupBy("feature", "_size").agg(
        *[F.count_if(F.col("cluster") == c).alias(col) for c, col in enumerate(_weight_cols(k))])


def centroid_stats(layout: Layout, assignment: DataFrame, k: int,
                   previous: Centroids | None = None) -> Centroids:
    """Centroid statistics of an assignment ``(entity, cluster)``.  A cluster
    left without members keeps its previous centroid.

    The weights are stored, which cuts the lineage: the next assignment depends
    only on the cells and these.
    """
    cols = _weight_cols(k)
    table, drop = stored(cluster_weights(layout, assignment, k))

    def facts(weights: DataFrame, sizes: DataFrame):
        square = [F.coalesce(F.sum(F.when(~F.col("_size"), F.col(c) * F.col(c))), F.lit(0)).alias(f"q{c}")
                  for c in cols]
        mark = F.sum(F.when(~F.col("_size"), F.xxhash64("feature", *cols)).cast("decimal(38,0)"))
        return weights.unionByName(sizes).agg(
            *[F.coalesce(F.max(F.when(F.col("_size"), F.col(c))), F.lit(0)).alias(c) for c in cols],
            *square, F.count(F.lit(1)).alias("rows"), mark.alias("mark")).first()

    weights, sizes = table.where(~F.col("_size")), table.where("_size")
    row = facts(weights, sizes)
    have = [int(row[c]) for c in cols]
    empty = [c for c in range(k) if have[c] == 0]
    if empty and previous is not None:
        old = previous.weights.select("feature", *[F.col(cols[c]).alias(f"_old{c}") for c in empty])
        merged = weights.join(old, weights["feature"].eqNullSafe(old["feature"]), "full_outer").select(
            F.coalesce(weights["feature"], old["feature"]).alias("feature"), F.lit(False).alias("_size"),
            *[F.coalesce(F.col(f"_old{c}" if c in empty else cols[c]), F.lit(0)).alias(cols[c])
              for c in range(k)])
        weights, again = stored(merged)
        row = facts(weights, sizes)
        first = drop
        drop = lambda: (first(), again())
        have = [previous.sizes[c] if c in empty else have[c] for c in range(k)]
    return Centroids(weights.select("feature", *cols), have, [int(row[f"q{c}"]) for c in cols],
                     (row["rows"], row["mark"], tuple(have)), drop)


def distance_expr(nx, dot, m: int, sq: int):
    """``|x| - 2*dot/m + sq/m^2`` in doubles, in this association order."""
    md = F.lit(float(m))
    return (nx.cast("double") - (F.lit(2.0) * dot.cast("double")) / md
            + F.lit(float(sq)) / (md * md))


def assign(layout: Layout, centroids: Centroids) -> DataFrame:
    """``(entity, cluster)``: the nearest centroid of every entity.  Only the
    weights and partial sums per entity move."""
    k = len(centroids.sizes)
    moved = _salted(centroids.weights, layout.feature_salts, "feature")
    per_entity = _dots_of(layout.by_feature.join(moved, ["feature", "_salt"], "left"), k)
    return _nearest(per_entity, centroids.sizes, centroids.sq)


def _dots_of(weighted: DataFrame, k: int) -> DataFrame:
    """``(entity, _nx, _d0 ..)`` from the cells with the weights of their features."""
    return weighted.groupBy("entity").agg(
        F.count(F.lit(1)).alias("_nx"),
        *[F.coalesce(F.sum(col), F.lit(0)).alias(f"_d{c}") for c, col in enumerate(_weight_cols(k))])


def _nearest(per_entity: DataFrame, sizes: list[int], sq: list[int]) -> DataFrame:
    candidates = [
        F.struct(distance_expr(F.col("_nx"), F.col(f"_d{c}"), m, q).alias("d"), F.lit(c).alias("c"))
        for c, (m, q) in enumerate(zip(sizes, sq))
    ]
    best = F.least(*candidates) if len(sizes) > 1 else candidates[0]
    return per_entity.select("entity", best.getField("c").alias("cluster"))


def _chosen_centroids(cells: DataFrame, k: int, seed: int,
                      candidates: DataFrame | None = None) -> DataFrame:
    """The k initial entities, stored (k rows); fewer entities than k is an
    error, as sampling k of fewer would be."""
    if k < 1:
        raise ValueError("k must be at least 1")
    init, _ = stored(init_centroids(cells, k, seed, candidates))
    found = init.count()
    if found < k:
        raise ValueError(f"k={k} exceeds the {found} entities to choose from")
    return init


@dataclass
class KMeansResult:
    assignment: DataFrame       # (entity, cluster), stored
    rounds: int                 # assignment rounds run
    centroids: DataFrame        # (cluster, entity): the initial entities
    drop: Callable[[], None]

    def release(self) -> None:
        """Drop the stored assignment and centroids once they have been used."""
        self.drop()


def lloyd_rounds(layout: Layout, init: DataFrame, k: int
                 ) -> Iterator[tuple[DataFrame, Callable[[], None]]]:
    """The assignment of each round, to be used before the next one is asked
    for, until it is stable; the last one stays until its drop is called.

    An assignment follows from the weights and sizes before it, so equal ones
    in two rounds running mean a fixed point.  Equal ones further apart would
    mean a cycle, which is an error.
    """
    centroids = centroid_stats(layout, init, k)
    seen = set()
    while True:
        assignment = assign(layout, centroids)
        yield assignment, centroids.drop
        old, centroids = centroids, centroid_stats(layout, assignment, k, centroids)
        if centroids.mark == old.mark and seen:
            centroids.drop()
            return
        old.drop()
        if centroids.mark in seen:
            raise RuntimeError("k-means came back to an earlier state: it cycles")
        seen.add(centroids.mark)


def kmeans(cells: DataFrame, k: int, seed: int, candidates: DataFrame | None = None) -> KMeansResult:
    """Lloyd iterations from seeded centroids until assignments are stable.

    Rounds are those of :mod:`larch.operators.bounded`, which give the assignments of
    :func:`lloyd_rounds` and read only what changed.  The last assignment stays stored
    and the layouts are released; ``release()`` on the result drops it.
    """
    from larch.operators import bounded

    init = _chosen_centroids(cells, k, seed, candidates)
    layout = lay_out(cells, both=False)
    assignment, rounds, drop = bounded.converged(layout, init, k)
    layout.release()
    return KMeansResult(assignment, rounds, init, drop)


def members(assignment: DataFrame, init: DataFrame) -> DataFrame:
    """``(centroid, entity)``: every entity with the initial entity of its
    cluster, one row per member (a cluster may hold a large share of all
    entities, so members are not gathered into one list)."""
    named = F.broadcast(init.withColumnRenamed("entity", "centroid"))  # k rows
    return assignment.join(named, "cluster").select("centroid", "entity")


def first_assignment(cells: DataFrame, k: int, seed: int,
                     candidates: DataFrame | None = None) -> DataFrame:
    """The members of each initial centroid, ordered by centroid and entity."""
    init = _chosen_centroids(cells, k, seed, candidates)
    # One pass: the cells are not worth laying out.
    weights, _ = stored(cells.join(F.broadcast(init), "entity").groupBy("feature").agg(
        *[F.count_if(F.col("cluster") == c).alias(col) for c, col in enumerate(_weight_cols(k))]))
    sq = weights.agg(*[F.sum(F.col(c) * F.col(c)) for c in _weight_cols(k)]).first()
    per_entity = _dots_of(cells.select("entity", "feature").join(weights, "feature", "left"), k)
    kept, _ = stored(_nearest(per_entity, [1] * k, [int(q or 0) for q in sq]))
    return members(kept, init).orderBy("centroid", "entity")


def cluster_sizes(assignment: DataFrame) -> DataFrame:
    return assignment.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
