"""Balanced label propagation: linked documents move towards their neighbours'
shards under capacity quotas.  DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larch.llm.common import text_or_empty, written

#: How far a shard may exceed the even share while labels move.
SLACK = 0.03
#: Rounds without a smaller cut before the best assignment is taken.
PATIENCE = 2


def _even(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def _pick(values: list, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def equal_text_links(rows: DataFrame, node: str = "node", group: str = "group") -> DataFrame:
    """One link ``(a, b)`` from every row to the smallest node of its group: as
    many links as rows, however large a group is."""
    hubs = rows.groupBy(group).agg(F.min(node).alias("b"), F.count(F.lit(1)).alias("_n"))
    return rows.join(hubs.where("_n > 1").drop("_n"), group).where(
        F.col(node) != F.col("b")).select(F.col(node).alias("a"), "b")


def _allowed(wanted: dict, sizes: list[int], capacity: int) -> dict:
    """How many may move from shard i to shard j: as many as want the opposite
    way, and a share of what room j has left."""
    shards = range(len(sizes))
    out = {}
    for j in shards:
        matched = {i: min(wanted.get((i, j), 0), wanted.get((j, i), 0)) for i in shards}
        rest = {i: wanted.get((i, j), 0) - matched[i] for i in shards}
        room, demand = max(0, capacity - sizes[j]), sum(rest.values())
        for i in shards:
            extra = rest[i] if demand <= room else room * rest[i] // demand
            out[i, j] = matched[i] + extra
    return out


def propagate(linked: DataFrame, links: DataFrame, fixed_sizes: list[int], total: int,
              shards: int, slack: float = SLACK) -> DataFrame:
    """Labels ``(node, shard)`` of the linked nodes.

    Every round joins the links with the current labels, counts each node's
    neighbours per shard, and lets a node move to the shard with the most of
    them.  Quotas bound the moves between each pair of shards; larger gains go
    first.  Half of the nodes, chosen by a hash, may move in a round, so two
    neighbours do not swap forever.  It ends when the cut has not shrunk for
    ``PATIENCE`` rounds and returns the labels with the smallest cut.

    Only counts per pair of shards and gain come to the driver.
    """
    both = written(links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = written(linked.select("node", F.pmod(
        F.xxhash64("node", F.lit("start")), F.lit(shards)).cast("int").alias("shard")), "labels")
    capacity = math.ceil((1 + slack) * total / shards)
    best, best_cut, stale, turn = labels, None, 0, 0
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "shard"), "b").groupBy(
            "a", "shard").agg(F.count(F.lit(1)).alias("n"))
        own = near.join(labels.select(F.col("node").alias("a"), F.col("shard").alias("src")), "a")
        votes = written(own.groupBy("a", "src").agg(
            F.max(F.struct("n", (F.col("shard") == F.col("src")).alias("stay"),
                           (-F.col("shard")).alias("minus"))).alias("top"),
            F.sum(F.when(F.col("shard") == F.col("src"), F.col("n")).otherwise(0)).alias("here"),
            F.sum("n").alias("all")).select(
            F.col("a").alias("node"), "src", (-F.col("top.minus")).cast("int").alias("dst"),
            (F.col("top.n") - F.col("here")).alias("gain"),
            (F.col("all") - F.col("here")).alias("cut"),
            (F.pmod(F.xxhash64("a", F.lit(turn)), F.lit(1000)) / 1000.0).alias("u")), "votes")
        cut = votes.agg(F.coalesce(F.sum("cut"), F.lit(0))).first()[0] // 2
        if best_cut is None or cut < best_cut:
            best, best_cut, stale = labels, cut, 0
        else:
            stale += 1
        if best_cut == 0 or stale >= PATIENCE:
            return best
        movers = votes.where((F.col("gain") > 0) & (F.col("u") < 0.5)).withColumn(
            "level", F.least(F.floor(F.log2("gain")).cast("int"), F.lit(40)))
        levels = {}
        for r in movers.groupBy("src", "dst", "level").count().collect():
            levels.setdefault((r["src"], r["dst"]), {})[r["level"]] = r["count"]
        sizes = list(fixed_sizes)
        for r in labels.groupBy("shard").count().collect():
            sizes[r["shard"]] += r["count"]
        allowed = _allowed({k: sum(v.values()) for k, v in levels.items()}, sizes, capacity)
        # Per pair: levels above the marginal one move, and a share of that one.
        marginal, share = {}, {}
        for pair, by_level in levels.items():
            left = allowed[pair]
            for level in sorted(by_level, reverse=True):
                marginal[pair], share[pair] = level, min(1.0, left / by_level[level])
                if left < by_level[level]:
                    break
                left -= by_level[level]
        pairs = [(i, j) for i in range(shards) for j in range(shards)]
        at = F.col("src") * shards + F.col("dst")
        limit = _pick([marginal.get(p, 99) for p in pairs], at)
        part = _pick([float(share.get(p, 0.0)) for p in pairs], at)
        moved = movers.where((F.col("level") > limit) | (
            (F.col("level") == limit) & (F.col("u") * 2 < part))).select(
            "node", F.col("dst").alias("_dst"))
        labels = written(labels.join(moved, "node", "left").select(
            "node", F.coalesce("_dst", "shard").alias("shard")), "labels")
        turn += 1


def _slots(labelled: DataFrame, total: int) -> DataFrame:
    """Adds ``slot``: a gapless number within the shard, linked rows first.

    Rows are numbered within buckets of about the square root of the table, and
    the buckets' counts give each its offset, so no task holds a shard.
    """
    buckets = max(1, total // max(2000, math.isqrt(total)))
    dealt = labelled.withColumn("_bucket", F.pmod(F.xxhash64("node", F.lit("slot")), F.lit(buckets)))
    keys = ["shard", "single", "_bucket"]
    counts = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(*keys, (F.sum("_n").over(
        Window.partitionBy("shard").orderBy("single", "_bucket")) - F.col("_n")).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("node")) - 1
    return dealt.withColumn("_rank", rank).join(offsets, keys).withColumn(
        "slot", (F.col("_offset") + F.col("_rank")).cast("long")).drop(
        "_bucket", "_rank", "_offset", "single")


def balanced_shards(rows: DataFrame, links: DataFrame, shards: int,
                    slack: float = SLACK) -> DataFrame:
    """``(node, shard int, slot long)`` for every node of ``rows``: shard sizes
    in rows differ by at most one, ``slot`` is gapless from 0 in each shard.

    ``rows`` has a unique column ``node``; ``links(a, b)`` joins nodes.  Nodes
    without links start evenly and stay unless a shard is too full at the end:
    its last slots, those of unlinked nodes first, go to the shards with room.
    No links, no rows and self-links are fine.
    """
    links = written(links.where(F.col("a") != F.col("b")).distinct(), "links")
    linked = written(links.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "linked")
    flagged = written(rows.select("node").join(
        linked.select("node", F.lit(True).alias("_l")), "node", "left").select(
        "node", F.col("_l").isNull().alias("single"),
        F.pmod(F.xxhash64("node", F.lit("even")), F.lit(shards)).cast("int").alias("start")), "nodes")
    sizes = [0] * shards
    total = 0
    for r in flagged.groupBy("single", "start").count().collect():
        total += r["count"]
        sizes[r["start"]] += r["count"] * r["single"]
    labels = propagate(linked, links, sizes, total, shards, slack)
    labelled = flagged.join(labels, "node", "left").select(
        "node", "single", F.coalesce("shard", "start").alias("shard"))
    placed = written(_slots(labelled, total), "slots")
    have = [0] * shards
    for r in placed.groupBy("shard").count().collect():
        have[r["shard"]] = r["count"]
    want = _even(total, shards)
    over, room, spill, free = [], [], 0, 0
    for j in range(shards):
        over.append(spill)
        spill += max(0, have[j] - want[j])
        room.append(free)
        free += max(0, want[j] - have[j])
    # Surplus rows in shard and slot order fill the free slots in shard order.
    number = _pick(over, F.col("shard")) + F.col("slot") - _pick(want, F.col("shard"))
    target = F.lit(None).cast("int")
    for k in range(shards):
        if want[k] > have[k]:
            inside = (F.col("_n") >= room[k]) & (F.col("_n") < room[k] + want[k] - have[k])
            target = F.when(inside, F.lit(k)).otherwise(target)
    return (placed.withColumn("_n", F.when(
        F.col("slot") >= _pick(want, F.col("shard")), number))
        .withColumn("_to", F.when(F.col("_n").isNotNull(), target))
        .select("node", F.coalesce("_to", "shard").cast("int").alias("shard"), F.when(
            F.col("_to").isNotNull(),
            _pick(have, F.col("_to")) + F.col("_n") - _pick(room, F.col("_to"))
        ).otherwise(F.col("slot")).cast("long").alias("slot")))


def keyed_rows(docs: DataFrame, *columns: str, text_col: str = "text") -> DataFrame:
    """The named columns of every row with ``size`` (UTF-8 bytes of the text
    plus 1), ``text_crc32``, the group of equal texts and a unique ``node``,
    written once so that the numbers stay."""
    text = text_or_empty(text_col)
    return written(docs.select(
        *columns, (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("group"),
        F.monotonically_increasing_id().alias("node")), "rows")


def shard_documents(docs: DataFrame, shards: int, text_col: str = "text",
                    columns: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` with ``size``, ``text_crc32``, ``shard`` and
    ``slot``; documents with equal texts are linked.

    Null texts count as empty and are equal to each other and to empty ones.
    Repeated rows are rows of their own.  Columns of ``docs`` with the names of
    added ones are replaced.  An empty table gives an empty result.
    """
    own = {"size", "text_crc32", "group", "node", "shard", "slot"}
    names = [c for c in (columns if columns is not None else docs.columns) if c not in own]
    rows = keyed_rows(docs, *names, text_col=text_col)
    placed = balanced_shards(rows, equal_text_links(rows), shards)
    return rows.join(placed, "node").drop("node", "group")
