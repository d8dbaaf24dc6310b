"""Hard negatives by shared candidate lists of anchor clusters.

Anchors are clustered by direction.  A candidate's inner product with any member
of a cluster is at most the product of their lengths and the cosine of its angle to
the centroid less the cluster's widest angle.  For each cluster a block of candidates
is sorted by that bound once; every member walks this one list until the bound of what
is left lies under the score it still needs, so nothing that counts is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larch.llm.common import tasks_for, written

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH, WHOLE = 30, 90, 100
#: Components of the anchors sent to the tasks at a time (32 MB), and of a block of
#: candidates that is sorted at a time.
BATCH_COMPONENTS = 4_000_000
BLOCK_COMPONENTS = 4_000_000
FIRST_ROWS, MOST_ROWS = 256, 4096
#: Bounds are computed in double precision; this covers their errors.
ANGLE_SLACK, SCORE_SLACK = 1e-6, 1e-9
_EXACT, _LEAST, _MOST = 2**53, -2**63, 2**63 - 1
RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, "
          "positive_score long, negative_score long")


def _lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows * rows).sum(axis=1))


def _units(rows: np.ndarray) -> np.ndarray:
    """Unit vectors; the zero vector stays."""
    size = _lengths(rows)
    return rows / np.where(size > 0, size, 1)[:, None]


class Clusters:
    """Directions of one batch of anchors, grouped by spherical k-means."""

    def __init__(self, anchors: np.ndarray, rounds: int = 6):
        unit = _units(anchors)
        count = max(1, round(len(anchors) ** 0.5))
        rng = np.random.default_rng(len(anchors))
        centres = unit[np.sort(rng.permutation(len(unit))[:count])]
        for _ in range(rounds):
            own = np.argmax(unit @ centres.T, axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, own, unit)
            centres = np.where(_lengths(sums)[:, None] > 0, _units(sums), centres)
        self.centres = centres
        self.own = np.argmax(unit @ centres.T, axis=1)
        angle = np.arccos(np.clip((unit * centres[self.own]).sum(axis=1), -1, 1))
        # The zero vector has no direction, but no product with it passes zero.
        angle[~unit.any(axis=1)] = np.pi
        self.spread = np.zeros(len(centres))
        np.maximum.at(self.spread, self.own, angle)

    def bounds(self, unit: np.ndarray, size: np.ndarray) -> np.ndarray:
        """``[cluster, row]``: what the row's product with any member of the cluster
        cannot pass, for members of length one."""
        angle = np.arccos(np.clip(self.centres @ unit.T, -1, 1))
        return size * np.cos(np.maximum(0, angle - self.spread[:, None] - ANGLE_SLACK))


class Wanted:
    """Searches of one batch of anchors: the ``k`` best rows of equal (or other)
    label with a score in ``low .. high`` for the anchor ``at``."""

    def __init__(self, ids, labels, anchors, clusters, at, place, low, high, k: int, same: bool):
        self.ids, self.labels, self.anchors, self.clusters = ids, labels, anchors, clusters
        self.at, self.place, self.low, self.high = at, place, low, high
        self.k, self.same = k, same
        self.size = _lengths(anchors)
        self.widest = float(np.abs(anchors).max(initial=0))


class _Best:
    """The best rows so far of every search: score descending, then id."""

    def __init__(self, wanted: Wanted):
        n = len(wanted.at)
        self.k, self.need = wanted.k, wanted.low.copy()
        self.scores = np.full((n, self.k), _LEAST, np.int64)
        self.ids = np.zeros((n, self.k), np.int64)
        self.count = np.zeros(n, np.int64)

    def add(self, search: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(search)
        old = np.arange(self.k)[None, :] < self.count[touched][:, None]
        search = np.concatenate((np.repeat(touched, self.count[touched]), search))
        scores = np.concatenate((self.scores[touched][old], scores.astype(np.int64)))
        ids = np.concatenate((self.ids[touched][old], ids))
        order = np.lexsort((ids, -scores, search))
        search = search[order]
        rank = np.arange(len(search)) - np.searchsorted(search, search)
        kept = rank < self.k
        search, rank, order = search[kept], rank[kept], order[kept]
        self.scores[search, rank], self.ids[search, rank] = scores[order], ids[order]
        np.maximum.at(self.count, search, rank + 1)
        full = touched[self.count[touched] == self.k]
        self.need[full] = np.maximum(self.need[full], self.scores[full, self.k - 1])


def _products(anchors: np.ndarray, rows: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of whole numbers, exact also beyond double precision."""
    if exact:
        return anchors @ rows.T
    return anchors.astype(np.int64) @ rows.T.astype(np.int64)


def walk(wanted: Wanted, best: _Best, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> int:
    """Searches one block of candidates; returns the products computed."""
    clusters, computed = wanted.clusters, 0
    width = wanted.anchors.shape[1]
    if rows.shape[1] > width:  # products of longer rows end with the anchors
        size, shown = _lengths(rows), np.ascontiguousarray(rows[:, :width])
        unit = shown / np.where(size > 0, size, 1)[:, None]
    else:
        shown = np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
        size, unit = _lengths(rows), _units(shown)
    exact = width * wanted.widest * float(np.abs(rows).max(initial=0)) < _EXACT
    bounds = clusters.bounds(unit, size)
    for cluster, bound in enumerate(bounds):
        going = np.flatnonzero((clusters.own[wanted.at] == cluster) & (wanted.low <= wanted.high))
        order = np.argsort(-bound, kind="stable")
        at, step = 0, FIRST_ROWS
        while at < len(order) and len(going):
            part = order[at:at + step]
            anchors, which = np.unique(wanted.at[going], return_inverse=True)
            scores = _products(wanted.anchors[anchors], shown[part], exact)[which]
            computed += scores.size
            own = wanted.at[going]
            hit = (scores >= best.need[going][:, None]) & (scores <= wanted.high[going][:, None])
            hit &= (labels[part][None, :] == wanted.labels[own][:, None]) == wanted.same
            if wanted.same:
                hit &= ids[part][None, :] != wanted.ids[own][:, None]
            search, row = np.nonzero(hit)
            if len(search):
                best.add(going[search], scores[search, row], ids[part][row])
            at, step = at + step, min(2 * step, MOST_ROWS)
            if at < len(order):
                reach = bound[order[at]] * wanted.size[wanted.at[going]]
                reach += np.abs(reach) * SCORE_SLACK + SCORE_SLACK
                going = going[reach >= best.need[going]]
    return computed


def _matrix(lists: pa.Array) -> np.ndarray:
    """Vectors as rows, shorter ones filled with zeros."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    rows = np.zeros((len(sizes), width))
    rows[np.repeat(np.arange(len(sizes)), sizes),
         np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return rows


def _blocks(batches: Iterator[pa.RecordBatch]):
    """``(ids, labels, rows)`` of about ``BLOCK_COMPONENTS`` components."""
    held, components = [], 0

    def block():
        whole = pa.Table.from_batches(held).combine_chunks()
        return (whole["id"].to_numpy(), whole["label"].to_numpy(),
                _matrix(whole["vector"].combine_chunks()))

    for batch in batches:
        held.append(batch)
        components += len(batch.column("vector").flatten())
        if components >= BLOCK_COMPONENTS:
            yield block()
            held, components = [], 0
    if held:
        yield block()


def _found(rows: DataFrame, wanted: Wanted) -> DataFrame:
    """``(search, id, score)``: the best rows of each task, merged."""
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(shared.value)
        for ids, labels, vectors in _blocks(batches):
            walk(shared.value, best, ids, labels, vectors)
        full = np.arange(best.k)[None, :] < best.count[:, None]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.nonzero(full)[0].astype(np.int64)), pa.array(best.ids[full]),
             pa.array(best.scores[full])], ["search", "id", "score"])

    found = rows.mapInArrow(search, "search long, id long, score long")
    order = Window.partitionBy("search").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted.k)


def whole_vectors(vector: Column, scale: float) -> Column:
    """``floor(scale * x)`` of every component, in double precision."""
    def whole(x: Column) -> Column:
        y = x.cast("double") * scale
        # Beyond 2^53 a double is a whole number.
        return F.when(F.abs(y) < float(_EXACT), F.floor(y).cast("double")).otherwise(y)

    return F.transform(vector, whole)


def hard_negatives(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id",
                   vector_col: str = "embedding", label_col: str = "label", scale: float = 256.0,
                   positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, whole: int = WHOLE) -> DataFrame:
    """Hard negatives of every row for which ``is_anchor`` holds.

    Components become ``floor(scale * x)``; a score is the inner product with the
    anchor, higher scores first and ties by smaller id.  An anchor's positives are its
    first ``positives`` rows of the same label and another id.  For each, the result
    has the first ``negatives`` rows of another label whose score times ``whole`` lies
    between ``low`` and ``high`` times the positive's score, ranked from 1, as
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Rows without an id, a label or a vector, with a null or non-finite component, or
    with a component so large that scores pass a long take no part.  Vectors of
    unequal lengths are filled with zeros.  Rows that repeat an id are rows of their own,
    but make one anchor (the least label and vector).  A positive with a negative
    score has no negatives.  No anchors or an empty table give an empty result; other
    columns, whatever their names, are not read.

    Anchors go to the tasks in batches of bounded size; every batch reads the table
    twice, moves no candidate, and its results are written to the shared folder.
    """
    spark = rows.sparkSession
    plain = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        whole_vectors(F.col(vector_col), scale).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("_anchor"),
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
    width = plain.agg(F.max(F.size("vector"))).first()[0] or 1
    largest = float(int((_MOST / width) ** 0.5))
    fits = F.forall("vector", lambda x: F.coalesce(F.abs(x) < largest, F.lit(False)))
    valid = plain.where(fits)
    candidates = valid.select("id", "label", "vector")
    # Written once: every batch reads its rows of it.
    anchors = written(valid.where("_anchor").groupBy("id")
                      .agg(F.min(F.struct("label", "vector")).alias("row"))
                      .select("id", "row.label", "row.vector"), "anchors")
    batches = tasks_for(anchors.count(), max(1, BATCH_COMPONENTS // width))
    results = []
    for batch in range(batches):
        table = (anchors.where(F.pmod(F.xxhash64("id"), F.lit(batches)) == batch)
                 .orderBy("id").toArrow().combine_chunks())
        if table.num_rows:
            results.append(_batch(candidates, table, positives, negatives, low, high, whole))
    if not results:
        return spark.createDataFrame([], RESULT)
    result = results[0]
    for more in results[1:]:
        result = result.unionAll(more)
    return result


def _batch(candidates: DataFrame, table: pa.Table, positives: int, negatives: int,
           low: int, high: int, whole: int) -> DataFrame:
    spark = candidates.sparkSession
    ids, labels = table["id"].to_numpy(), table["label"].to_numpy()
    anchors = _matrix(table["vector"].combine_chunks())
    clusters = Clusters(anchors)
    n = len(ids)
    first = Wanted(ids, labels, anchors, clusters, np.arange(n), np.zeros(n, np.int64),
                   np.full(n, _LEAST), np.full(n, _MOST), positives, True)
    # At most ``positives`` rows an anchor of the batch.
    near = _found(candidates, first).orderBy("search", "rank").toArrow()
    scores = near["score"].to_pylist()
    second = Wanted(ids, labels, anchors, clusters, near["search"].to_numpy(), near["rank"].to_numpy(),
                    np.array([-(-low * s // whole) for s in scores], np.int64),
                    np.array([high * s // whole for s in scores], np.int64), negatives, False)
    # The searches again as a table, as bounded as the batch.
    told = spark.createDataFrame(pa.table({
        "search": pa.array(range(len(scores)), pa.int64()),
        "anchor_id": ids[second.at], "positive_id": near["id"], "positive_score": near["score"]}))
    found = _found(candidates, second).withColumnRenamed("score", "negative_score")
    return written(found.join(F.broadcast(told), "search").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
        "positive_score", "negative_score"), "negatives")
