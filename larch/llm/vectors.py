"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors with cosine c are 2 - 2c apart in squared distance.  Rotated and
cut into blocks, a close pair is within the block's proportional share of that
budget in at least one block.  Each block is range-joined on a grid over its
first coordinates; pairs within the share are verified exactly.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larch.llm.common import written
from larch.llm.graph import components
from larch.llm.simhash import merge

COSINE = 0.95
BLOCK_DIMS = 8
#: Rows of a grid cell that one more grid coordinate should bring it under, and
#: rows of a cell compared in one task.
CELL_ROWS = 32_768
PART_ROWS = 16_384
CHUNK_ROWS = 256
MAX_GRID = 4
#: Rotated coordinates are rounded to single precision; this covers the error.
SLACK = 1e-5


class Blocks:
    """Rotation, blocks and budgets for vectors of one length."""

    _kept: dict = {}

    def __init__(self, dims: int, cosine: float):
        rng = np.random.default_rng(dims)
        self.rotation = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
        count = max(1, round(dims / BLOCK_DIMS))
        cuts = [round(i * dims / count) for i in range(count + 1)]
        self.spans = list(zip(cuts[:-1], cuts[1:]))
        whole = 2 - 2 * cosine + SLACK
        self.budgets = [whole * (e - s) / dims for s, e in self.spans]

    @classmethod
    def of(cls, dims: int, cosine: float) -> Blocks:
        if (dims, cosine) not in cls._kept:
            cls._kept[dims, cosine] = cls(dims, cosine)
        return cls._kept[dims, cosine]

    def rotated(self, unit: np.ndarray) -> np.ndarray:
        return (unit @ self.rotation).astype(np.float32).astype(np.float64)



def _unit(rows: np.ndarray) -> np.ndarray:
    # Scaled first, so very large and very small components keep their angle.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def cells(unit: np.ndarray, cosine: float, grid: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """``(block, rows, cell coordinates, home)``: every row's own cell, and as a
    probe the later neighbouring cells within the block's budget."""
    blocks = Blocks.of(unit.shape[1], cosine)
    y = blocks.rotated(unit)
    for b, ((start, end), budget) in enumerate(zip(blocks.spans, blocks.budgets)):
        width = math.sqrt(budget)
        scaled = y[:, start:min(end, start + grid)] / width
        home = np.floor(scaled).astype(np.int64)
        inside = scaled - home
        every = np.arange(len(y))
        yield b, every, home, True
        for step in itertools.product((-1, 0, 1), repeat=home.shape[1]):
            if step <= (0,) * len(step):
                continue
            gap = np.where(np.array(step) > 0, 1 - inside, inside) * (np.array(step) != 0)
            near = np.flatnonzero((gap * gap).sum(axis=1) <= 1 + 1e-9)
            yield b, near, home[near] + np.array(step), False


def _sides(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Factors whose product is all squared distances, in single precision."""
    one = lambda y: np.ones((len(y), 1))
    norm = lambda y: (y * y).sum(axis=1, keepdims=True)
    return (np.hstack((-2 * left, norm(left), one(left))).astype(np.float32),
            np.hstack((right, one(right), norm(right))).astype(np.float32).T)


def links(left: np.ndarray, right: np.ndarray, block: int, cosine: float,
          same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs linked at the cosine whose first block within its budget is
    ``block``; with ``same`` both sides are one and each pair comes once.

    Both sides are sorted by the block's last coordinate, and a chunk meets only
    rows within the block's width of it.
    """
    blocks = Blocks.of(left.shape[1], cosine)
    start, end = blocks.spans[block]
    lefts, rights = _unit(left), _unit(right)
    ly, ry = blocks.rotated(lefts), blocks.rotated(rights)
    lo, ro = (np.argsort(y[:, end - 1], kind="stable") for y in (ly, ry))
    lefts, rights, ly, ry = lefts[lo], rights[ro], ly[lo], ry[ro]
    width = math.sqrt(blocks.budgets[block]) + 1e-6
    limit = np.float32(blocks.budgets[block] + 1e-5)
    a_side, b_side = _sides(ly[:, start:end], ry[:, start:end])
    last = ry[:, end - 1]
    for at in range(0, len(left), CHUNK_ROWS):
        stop = min(at + CHUNK_ROWS, len(left))
        first = at if same else int(np.searchsorted(last, ly[at, end - 1] - width))
        until = int(np.searchsorted(last, ly[stop - 1, end - 1] + width, "right"))
        near = a_side[at:stop] @ b_side[:, first:until] <= limit
        if same:
            near &= np.arange(first, until)[None, :] > np.arange(at, stop)[:, None]
        if not near.any():
            continue
        dense = near.mean() > 0.02
        if dense:
            near &= lefts[at:stop] @ rights[first:until].T >= cosine
        i, j = np.nonzero(near)
        for part in range(0, len(i), 1 << 16):
            a, c = i[part:part + (1 << 16)] + at, j[part:part + (1 << 16)] + first
            if not dense:
                real = np.einsum("ij,ij->i", lefts[a], rights[c]) >= cosine
                a, c = a[real], c[real]
            gap = (ly[a] - ry[c]) ** 2
            here = np.ones(len(a), bool)
            for b in range(block + 1):
                s, e = blocks.spans[b]
                inside = gap[:, s:e].sum(1) <= blocks.budgets[b] + 1e-9
                here &= inside if b == block else ~inside
            if here.any():
                yield lo[a[here]], ro[c[here]]


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 cosine: float = COSINE, grid: int | None = None,
                 part_rows: int = PART_ROWS) -> DataFrame:
    """``(id, n_links long, component_id)`` per row: vectors of other rows with
    at least this cosine, and the smallest id that links reach.

    Equal vectors form a class that is compared once.  A vector that is null,
    empty or zero, or has null or non-finite components, links with nothing; so
    do vectors of different lengths.  A cell over ``part_rows`` rows is compared
    in several tasks.  Tasks return link counts per class and the links of a
    spanning forest, never all pairs.  Null ids count as vectors but are never
    the smallest id unless nothing else is; repeated rows link with each other.
    """
    v = F.col("vector")
    proper = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: (
        x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))) & F.exists(v, lambda x: x != 0)
    single = "array<float>" in rows.select(vector_col).dtypes[0][1]
    kind, dtype = ("float", np.float32) if single else ("double", np.float64)
    base = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast(f"array<{kind}>").alias("vector"))
    good = base.where(proper)
    classes = written(good.groupBy("vector").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("least")).select(
        "vector", "copies", "least", F.size("vector").alias("dims"),
        F.monotonically_increasing_id().alias("node")), "vectors")
    total = classes.count()
    if grid is None:
        grid = min(MAX_GRID, max(1, math.ceil(math.log(max(1.0, total / CELL_ROWS)) / math.log(4.5))))

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dims, part in batch.groupby("dims"):
                node = part["node"].to_numpy()
                unit = _unit(np.array([np.asarray(x, np.float64) for x in part["vector"]]))
                for b, which, cell, home in cells(unit, cosine, grid):
                    yield pd.DataFrame({
                        "node": node[which], "dims": dims, "block": b, "home": home,
                        "cell": [",".join(map(str, c)) for c in cell.tolist()]})

    keys = written(classes.select("node", "dims", "vector").mapInPandas(
        keyed, "node long, dims int, block int, home boolean, cell string"), "cells")
    place = ["dims", "block", "cell"]
    sizes = keys.groupBy(*place).agg(
        F.ceil(F.count_if("home") / part_rows).cast("int").alias("homes"),
        F.ceil(F.count_if(~F.col("home")) / part_rows).cast("int").alias("probes")).where("homes > 0")
    mine = lambda n: F.pmod(F.xxhash64("node"), F.greatest(n, F.lit(1))).cast("int")
    # Home parts meet each other once; every probe part meets every home part.
    at_home = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("homes") - 1), lambda o: F.struct(
            F.least(mine(F.col("homes")), o).alias("i"), F.greatest(mine(F.col("homes")), o).alias("j"))),
        F.when(F.col("probes") > 0, F.transform(
            F.sequence(F.lit(0), F.col("probes") - 1), lambda o: F.struct(
                mine(F.col("homes")).alias("i"), (-1 - o).alias("j")))).otherwise(
            F.array().cast("array<struct<i:int,j:int>>")))
    probing = F.transform(F.sequence(F.lit(0), F.col("homes") - 1), lambda o: F.struct(
        o.alias("i"), (-1 - mine(F.col("probes"))).alias("j")))
    tasks = keys.join(sizes, place).select(
        "node", *place, "home", mine(F.col("homes")).alias("mine"),
        F.explode(F.when(F.col("home"), at_home).otherwise(probing)).alias("t")).select(
        "node", *place, "home", "mine", F.col("t.i").alias("i"), F.col("t.j").alias("j"))
    full = tasks.join(classes.select("node", "vector", "copies"), "node")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j, block = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0]), int(pdf["block"].iloc[0])
        vectors = np.array([np.asarray(x, np.float64) for x in pdf["vector"]])
        node, copies = pdf["node"].to_numpy(np.int64), pdf["copies"].to_numpy(np.int64)
        home, part = pdf["home"].to_numpy(bool), pdf["mine"].to_numpy()
        left = np.flatnonzero(home & (part == i)) if j >= 0 else np.flatnonzero(home)
        right = left if i == j else np.flatnonzero(home & (part == j)) if j >= 0 else np.flatnonzero(~home)
        count, label = np.zeros(len(node), np.int64), np.arange(len(node))
        if len(left) and len(right):
            for a, c in links(vectors[left], vectors[right], block, cosine, i == j):
                a, c = left[a], right[c]
                np.add.at(count, a, copies[c])
                np.add.at(count, c, copies[a])
                label = merge(label, a, c)
        some, child = np.flatnonzero(count), np.flatnonzero(label != np.arange(len(node)))
        return pd.DataFrame({"a": np.concatenate((node[some], node[child])),
                             "b": np.concatenate((np.full(len(some), -1), node[label[child]])),
                             "n": np.concatenate((count[some], np.zeros(len(child), np.int64)))})

    found = written(full.groupBy(*place, "i", "j").applyInPandas(compare, "a long, b long, n long"), "found")
    counts = found.where("b < 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    linked = components(found.where("b >= 0").select("a", "b"))
    grouped = classes.select("node", "vector", "copies", "least").join(counts, "node", "left").join(
        linked, "node", "left").select(
        "vector", "least", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = written(grouped.join(least, "component").select("vector", "n_links", "component_id"), "named")
    linked_rows = good.join(named, "vector").select("id", "n_links", "component_id")
    alone = base.where(~F.coalesce(proper, F.lit(False))).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked_rows.unionAll(alone).withColumnRenamed("id", id_col)
