"""Alternating least squares by sums of normal equations.

MLlib sends the factor of a user to every block of items with one of the user's
items.  Here the side with more ids (``many``, as a rule the users) stays with its
ratings, dealt by id into blocks, and a block sends each id of the other side
(``few``) its normal equations: their sums, or the ratings and factors that make
them up where those are smaller.  The equations of an id are added and solved, and
its factor goes back to the blocks that sent some.  So a round moves no more than
the factor of every rating, and with few ids only sums, however many blocks there are.

The start, the equations (explicit ratings, ridge times the number of ratings), their
double precision and the order of the steps are MLlib's; factors are floats.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larch.session import stored, tasks_for

#: Ratings of one block.
RATINGS_PER_BLOCK = 250_000
#: Doubles of the factors that one step of a solution holds.
CELLS = 4_000_000

EQUATIONS = "block int, id int, n int, sums binary, ratings binary, factors binary"
SENT = "block int, id int, features array<float>"
FACTORS = "id int, features array<float>"


@dataclass
class Factors:
    """A fitted model: ``(id int, features array<float>)`` of users and items."""

    userFactors: DataFrame
    itemFactors: DataFrame

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a float ``prediction``; those of unknown users or items drop."""
        users = self.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("_user"))
        items = self.itemFactors.select(F.col("id").alias("itemId"), F.col("features").alias("_item"))
        products = F.zip_with("_user", "_item", lambda a, b: a.cast("double") * b)
        dot = F.aggregate(products, F.lit(0.0), lambda total, x: total + x).cast("float")
        return (rows.join(users, "userId").join(items, "itemId")
                .select(*rows.columns, dot.alias("prediction")).na.drop(subset=["prediction"]))


def _matrix(column: pa.ChunkedArray, rank: int) -> np.ndarray:
    """Factors of a column as rows."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, rank)


def _lists(factors: np.ndarray) -> pa.Array:
    fixed = pa.FixedSizeListArray.from_arrays(pa.array(factors.ravel()), factors.shape[1])
    return fixed.cast(pa.list_(pa.float32()))


def _ints(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _summed(known: np.ndarray, rating: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The normal equations of one id, from the factors of its ratings."""
    rank = known.shape[1]
    gram, right = np.zeros((rank, rank)), np.zeros(rank)
    for at in range(0, len(known), step := max(1, CELLS // rank)):
        rows = known[at:at + step].astype(np.float64)
        gram += rows.T @ rows
        right += rating[at:at + step].astype(np.float64) @ rows
    return gram, right


def _solved(group: np.ndarray, groups: int, at: np.ndarray, rating: np.ndarray, known: np.ndarray,
            reg: float) -> np.ndarray:
    """The factors of ids 0 to ``groups`` - 1: rating j is one of id ``group[j]`` for the
    factor ``known[at[j]]``.  Ids with equally many ratings are solved together, by the
    equations of the ratings where these are fewer than those of the factor."""
    rank = known.shape[1]
    order = np.argsort(group, kind="stable")
    at, rating = at[order], rating[order]
    counts = np.bincount(group, minlength=groups)
    first = np.cumsum(counts) - counts
    out = np.zeros((groups, rank), np.float32)
    for k in np.unique(counts[counts > 0]):
        same, step = np.flatnonzero(counts == k), max(1, CELLS // (int(k) * rank))
        if k >= rank:
            for one in same:
                rows = slice(first[one], first[one] + k)
                gram, right = _summed(known[at[rows]], rating[rows])
                out[one] = np.linalg.solve(gram + reg * k * np.eye(rank), right)
            continue
        for lo in range(0, len(same), step):
            some = same[lo:lo + step]
            rows = first[some][:, None] + np.arange(k)
            factors = known[at[rows]].astype(np.float64)
            gram = factors @ factors.transpose(0, 2, 1) + reg * k * np.eye(k)
            dual = np.linalg.solve(gram, rating[rows].astype(np.float64)[..., None])
            out[some] = (dual.transpose(0, 2, 1) @ factors)[:, 0]
    return out


def _places(ids: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place in ``ids`` of each wanted id."""
    order = np.argsort(ids)
    return order[np.searchsorted(ids, wanted, sorter=order)]


def _equations(block: int, rated: pa.Table, ids: np.ndarray, factors: np.ndarray) -> pa.Table:
    """What a block sends the ids of the other side, by the factors of its own ``ids``."""
    few, many, rating = _ints(rated, "few"), _ints(rated, "many"), _ints(rated, "rating")
    order = np.lexsort((rating, many, few))
    few, at, rating = few[order], _places(ids, many[order]), rating[order]
    wanted, first, counts = np.unique(few, return_index=True, return_counts=True)
    rank = factors.shape[1]
    upper = np.triu_indices(rank)
    sums, ratings, sent = [], [], []
    for lo, n in zip(first, counts):
        mine = factors[at[lo:lo + n]]
        whole = n * (rank + 1) * 4 > (len(upper[0]) + rank) * 8
        if whole:
            gram, right = _summed(mine, rating[lo:lo + n])
            sums.append(np.concatenate([gram[upper], right]).tobytes())
        else:
            sums.append(None)
        ratings.append(None if whole else rating[lo:lo + n].tobytes())
        sent.append(None if whole else mine.tobytes())
    return pa.table({"block": pa.array(np.full(len(wanted), block, np.int32)), "id": pa.array(wanted),
                     "n": pa.array(counts.astype(np.int32)), "sums": pa.array(sums, pa.binary()),
                     "ratings": pa.array(ratings, pa.binary()), "factors": pa.array(sent, pa.binary())})


def _solved_block(rated: pa.Table, known: pa.Table, rank: int, reg: float) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a block and their factors, from those of the other side."""
    ids, group = np.unique(_ints(rated, "many"), return_inverse=True)
    at = _places(_ints(known, "id"), _ints(rated, "few"))
    return ids, _solved(group, len(ids), at, _ints(rated, "rating"), _matrix(known.column("features"), rank), reg)


def _started(key, rated: pa.Table, known: pa.Table, rank: int, reg: float) -> pa.Table:
    """A block's equations by the factors it starts from."""
    return _equations(key[0].as_py(), rated, _ints(known, "id"), _matrix(known.column("features"), rank))


def _stepped(key, rated: pa.Table, known: pa.Table, rank: int, reg: float) -> pa.Table:
    """A block's equations after it has solved its own ids."""
    return _equations(key[0].as_py(), rated, *_solved_block(rated, known, rank, reg))


def _ended(key, rated: pa.Table, known: pa.Table, rank: int, reg: float) -> pa.Table:
    """A block's own factors."""
    ids, factors = _solved_block(rated, known, rank, reg)
    return pa.table({"id": pa.array(ids), "features": _lists(factors)})


def _answered(sent: pa.Table, rank: int, reg: float) -> pa.Table:
    """The factors of some ids, from what all blocks sent, for each of these blocks."""
    sent = sent.sort_by([("id", "ascending"), ("block", "ascending")])
    ids, group = np.unique(_ints(sent, "id"), return_inverse=True)
    n, sums = _ints(sent, "n").astype(np.int64), sent.column("sums").to_pylist()
    ratings, factors = sent.column("ratings").to_pylist(), sent.column("factors").to_pylist()
    summed = np.zeros(len(ids), bool)
    summed[group[[s is not None for s in sums]]] = True
    out = np.zeros((len(ids), rank), np.float32)

    def rows(places):
        return (np.frombuffer(b"".join(ratings[p] for p in places), np.float32),
                np.frombuffer(b"".join(factors[p] for p in places), np.float32).reshape(-1, rank))

    plain = np.flatnonzero(~summed[group])
    if len(plain):
        rating, known = rows(plain)
        names, of = np.unique(group[plain], return_inverse=True)
        out[names] = _solved(np.repeat(of, n[plain]), len(names), np.arange(len(rating)), rating, known, reg)
    upper = np.triu_indices(rank)
    first = np.searchsorted(group, np.arange(len(ids) + 1))
    for one in np.flatnonzero(summed):
        places = range(first[one], first[one + 1])
        rating, known = rows([p for p in places if sums[p] is None])
        gram, right = _summed(known, rating)
        for p in places:
            if sums[p] is not None:
                packed = np.frombuffer(sums[p], np.float64)
                part = np.zeros((rank, rank))
                part[upper] = packed[:len(upper[0])]
                gram += part + np.triu(part, 1).T
                right += packed[len(upper[0]):]
        ridge = reg * n[first[one]:first[one + 1]].sum()
        out[one] = np.linalg.solve(gram + ridge * np.eye(rank), right)
    return pa.table({"block": sent.column("block"), "id": sent.column("id"), "features": _lists(out[group])})


def fit(ratings: DataFrame, als: ALS) -> Factors:
    """The model of ``als`` on ``ratings`` (INT ids).  MLlib checks the ratings and makes
    the start, a fit of no rounds; the rounds are those of this module."""
    rank, reg, rounds = als.getRank(), als.getRegParam(), als.getMaxIter()
    start = als.copy({als.maxIter: 0}).fit(ratings)
    users, items = start.userFactors, start.itemFactors
    if not rounds:
        return Factors(users, items)
    by_user = users.count() >= items.count()
    many, few = (als.getUserCol(), als.getItemCol()) if by_user else (als.getItemCol(), als.getUserCol())
    blocks = max(8, tasks_for(ratings.count(), RATINGS_PER_BLOCK))

    def block(col):
        return F.pmod(F.hash(F.col(col).cast("int")), F.lit(blocks)).cast("int")

    rated = (ratings.select(block(many).alias("block"), F.col(many).cast("int").alias("many"),
                            F.col(few).cast("int").alias("few"),
                            F.col(als.getRatingCol()).cast("float").alias("rating"))
             .repartition(blocks, "block").persist())
    start = users.select("id", F.col("features").cast("array<float>").alias("features"))

    def met(known, by, schema):
        def joined(key: tuple[pa.Scalar, ...], mine: pa.Table, theirs: pa.Table) -> pa.Table:
            return by(key, mine, theirs, rank, reg)
        return rated.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(joined, schema)

    def solved(equations):
        def answered(sent: pa.Table) -> pa.Table:
            return _answered(sent, rank, reg)
        return equations.groupBy(block("id").alias("bucket")).applyInArrow(answered, SENT)

    try:
        if by_user:  # items, users, ..., items, users
            sent = solved(met(start.withColumn("block", block("id")), _started, EQUATIONS))
            for _ in range(rounds - 1):
                sent = solved(met(sent, _stepped, EQUATIONS))
            sent, _ = stored(sent)
            last = sent
        else:  # items by the users' start, users, ..., items, users
            links = rated.select(F.col("block").alias("block"), F.col("few").alias("id")).distinct()
            sent = links.join(start, "id").select("block", "id", "features")
            for _ in range(rounds - 1):
                sent = solved(met(sent, _stepped, EQUATIONS))
            sent, _ = stored(sent)
            last, _ = stored(solved(met(sent, _stepped, EQUATIONS)))
        mine, _ = stored(met(sent, _ended, FACTORS))
    finally:
        rated.unpersist()
    other = last.groupBy("id").agg(F.first("features").alias("features"))
    return Factors(mine, other) if by_user else Factors(other, mine)
