"""SimHash near-duplicates: fingerprints of word shingles, compared within
candidate blocks on vertical bit planes."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larch.llm.common import text_or_empty, tasks_for, written
from larch.llm.graph import components

SHINGLE = 3
MAX_DISTANCE = 3
SEED = 42
#: Distinct fingerprints that one comparison block holds on average, and at most.
BLOCK_ROWS = 2048
BLOCK_LIMIT = 8192
QUERY_ROWS = 256
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of one text as an unsigned number; 0 without words."""
    words = text.lower().split()
    n = len(words)
    if n == 0:
        return 0
    if n < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = n - shingle + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[s:e], seed) for s, e in zip(starts[:count].tolist(),
                                                   ends[shingle - 1:].tolist())),
        np.uint64, count)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, 65536):
        part = hashes[at:at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE,
                      seed: int = SEED, out_col: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint as a signed 64-bit number; null texts have no words."""
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(t, shingle, seed) for t in texts], np.uint64)
        return pd.Series(values.view(np.int64))

    return docs.withColumn(out_col, simhash(text_or_empty(text_col).cast("binary")))


def bit_planes(values: np.ndarray) -> np.ndarray:
    """64 bit planes of unsigned fingerprints, 64 fingerprints to a word."""
    rows = -(-len(values) // 64) * 64
    padded = np.zeros(rows, "<u8")
    padded[:len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def close_pairs(queries: np.ndarray, members: np.ndarray, radius: int, same: bool):
    """Index pairs ``(query, member)`` at most ``radius`` bits apart, in chunks;
    with ``same`` both lists are one and each pair comes once.

    Three planes at a time go through a carry-save adder into saturating bitwise
    counters that hold the distances to 64 members per word.  A query leaves the
    block as soon as all its distances exceed the radius.
    """
    planes, width = bit_planes(members), -(-len(members) // 64)
    levels = max(1, int(radius).bit_length())
    start = (1 << levels) - 1 - radius  # the counters overflow beyond the radius
    position = np.arange(width * 64)
    for at in range(0, len(queries), QUERY_ROWS):
        rows = np.arange(at, min(at + QUERY_ROWS, len(queries)))
        done = (position[None, :] >= len(members)) | (
            (position[None, :] <= rows[:, None]) if same else False)
        over = np.packbits(np.broadcast_to(done, (len(rows), width * 64)), axis=1,
                           bitorder="little").view("<u8")
        masks = np.where(np.unpackbits(
            queries[rows].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
            bitorder="little").astype(bool), _FULL, np.uint64(0))
        counters = [np.full(over.shape, _FULL if start >> k & 1 else np.uint64(0))
                    for k in range(levels)]

        def add(value, level):
            for k in range(level, levels):
                carry = counters[k] & value
                counters[k] ^= value
                value = carry
            np.bitwise_or(over, value, out=over)

        for plane in range(0, 64, 3):
            alive = (over != _FULL).any(axis=1)
            if not alive.all():
                if not alive.any():
                    rows = rows[:0]
                    break
                rows, over, masks = rows[alive], over[alive], masks[alive]
                counters = [c[alive] for c in counters]
            xs = [planes[p][None, :] ^ masks[:, p:p + 1] for p in range(plane, min(plane + 3, 64))]
            if len(xs) < 3:
                for x in xs:
                    add(x, 0)
                continue
            x, y, z = xs
            half = x ^ y
            add((x & y) | (z & half), 1)
            add(half ^ z, 0)
        if len(rows):
            near = np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little")
            q, m = np.nonzero(near)
            yield rows[q], m


def merge(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Labels after joining the sets of ``left`` and ``right`` pairwise."""
    while True:
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while not np.array_equal(label, label[label]):
            label = label[label]


def block_count(distinct: int, radius: int, block_rows: int = BLOCK_ROWS) -> int:
    """Number of bit blocks: two fingerprints within the radius agree on all but
    ``radius`` of them, so longer keys (more blocks) suit larger tables."""
    for blocks in range(radius + 1, 2 * radius + 4):
        if distinct / 2.0 ** (64 * (blocks - radius) / blocks) <= block_rows / 2:
            return blocks
    return 2 * radius + 4


def keys(radius: int, blocks: int) -> list[int]:
    """Bit masks: one for each choice of ``blocks - radius`` blocks."""
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    spans = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    return [sum(chosen) for chosen in itertools.combinations(spans, blocks - radius)]


def near_edges(distinct: DataFrame, radius: int = MAX_DISTANCE, block_rows: int = BLOCK_ROWS,
               block_limit: int = BLOCK_LIMIT) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints that connect exactly the
    groups linked at ``radius`` bits or fewer.

    ``distinct`` has one column ``fingerprint``.  Each key table deals the
    fingerprints into comparison blocks by the hash of their masked bits, so
    equal keys meet.  A block over ``block_limit`` rows is split into parts, and
    each pair of parts is compared in a task of its own.  A block returns the
    links of a spanning forest, not all its pairs.
    """
    total = distinct.count()
    masks = keys(radius, block_count(total, radius, block_rows))
    groups = max(1, -(-total // block_rows))
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    dealt = distinct.select("fingerprint", F.posexplode(F.array(*[
        F.pmod(F.xxhash64(F.col("fingerprint").bitwiseAND(F.lit(m).cast("long"))), F.lit(groups))
        for m in signed])).alias("tab", "grp"))
    sizes = dealt.groupBy("tab", "grp").count().select(
        "tab", "grp", F.ceil(F.col("count") / (block_limit // 2)).alias("parts"))
    parts = sizes.where(F.col("parts") > 2)
    split = dealt.join(parts, ["tab", "grp"], "left").select(
        "fingerprint", "tab", "grp", F.coalesce("parts", F.lit(1)).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64("fingerprint", F.lit(7)), F.col("parts")).cast("int")
    paired = split.select("fingerprint", "tab", "grp", mine.alias("mine"), F.explode(
        F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select(
        "fingerprint", "tab", "grp", "mine",
        F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        values = pdf["fingerprint"].to_numpy(np.int64)
        first = (pdf["mine"] == i).to_numpy()
        order = np.concatenate((values[first], values[~first]))
        u = order.view(np.uint64)
        split_at = int(first.sum())
        label = np.arange(len(u))
        shift = 0 if i == j else split_at
        left, right = (u, u) if i == j else (u[:split_at], u[split_at:])
        if len(left) and len(right):
            for q, m in close_pairs(left, right, radius, i == j):
                label = merge(label, q, m + shift)
        child = np.nonzero(label != np.arange(len(u)))[0]
        return pd.DataFrame({"a": order[child], "b": order[label[child]]})

    return paired.groupBy("tab", "grp", "i", "j").applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = MAX_DISTANCE) -> DataFrame:
    """``(id, text_key, fingerprint, component_id, keep_id, keep_key)`` per row.

    ``fingerprint`` is the signed 64-bit SimHash, ``component_id`` the smallest
    id of the rows that links of at most ``radius`` bits reach.  ``keep_id`` and
    ``keep_key`` name the row of the group that stays: the smallest id (null
    before others), then the smallest hash of the text.

    Texts without words (null, empty) have the fingerprint zero and link like
    any other.  Equal rows share their group; equal fingerprints are compared
    once.  An empty table gives an empty result.  Other columns are not read.
    """
    rows = written(with_fingerprints(docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        F.xxhash64(text_or_empty(text_col)).alias("text_key"))).drop("text"), "fingerprints")
    distinct = written(rows.groupBy("fingerprint").agg(
        F.min(F.struct("id", "text_key")).alias("first"), F.min("id").alias("least")), "distinct")
    linked = components(near_edges(distinct.select("fingerprint"), radius))
    grouped = distinct.join(linked, distinct["fingerprint"] == linked["node"], "left").select(
        "fingerprint", "first", "least",
        F.coalesce("component", "fingerprint").alias("component"))
    group = grouped.groupBy("component").agg(
        F.min("first").alias("first"), F.min("least").alias("component_id"))
    classes = written(grouped.select("fingerprint", "component").join(group, "component").select(
        "fingerprint", "component_id", F.col("first.id").alias("keep_id"),
        F.col("first.text_key").alias("keep_key")), "classes")
    return rows.join(classes, "fingerprint").select(
        F.col("id").alias(id_col), "text_key", "fingerprint", "component_id", "keep_id", "keep_key")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE, radius: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs`` less all but one document of each near-duplicate
    group; columns as in ``docs``."""
    groups = near_duplicates(docs, id_col, text_col, shingle, radius)
    stay = groups.select(F.col("keep_id").alias("_id"), F.col("keep_key").alias("_key")).distinct()
    keyed = docs.withColumn("_key_of_text", F.xxhash64(text_or_empty(text_col)))
    kept = keyed.join(stay, keyed[id_col].eqNullSafe(stay["_id"])
                      & (keyed["_key_of_text"] == stay["_key"]), "left_semi")
    return kept.dropDuplicates([id_col, "_key_of_text"]).select(*docs.columns)
