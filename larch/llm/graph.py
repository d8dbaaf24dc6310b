"""Connected components of an edge table by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larch.llm.common import written


def _checksum(edges: DataFrame) -> tuple:
    """Row count and an order-free sum of row hashes."""
    return tuple(edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _linked(edges: DataFrame) -> DataFrame:
    """Every end of an edge with the other end and with the smallest id of its
    neighbourhood, itself included."""
    both = edges.select("a", "b").unionAll(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return both.join(least.select("a", F.least("a", "m").alias("m")), "a")


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is
    the smallest node that links reach.

    Alternates the large-star and small-star steps until the edges stay equal.
    Each step is one aggregation and one join on the node, so a node with very
    many links is one partial minimum per task and a skewed join that adaptive
    execution splits.  Every round is written to the shared folder.
    """
    current = written(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _checksum(current)
    while True:
        large = (_linked(current).where(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # Every edge now leads from a node to a smaller one.
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(
            F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")),
                              F.struct(F.col("b").alias("x"), F.col("m").alias("y")))).alias("e"))
        current = written(small.select(F.col("e.x").alias("a"), F.col("e.y").alias("b"))
                          .where(F.col("a") != F.col("b")).distinct(), "edges")
        before, state = state, _checksum(current)
        if state == before:
            break
    # The edges are stars now: each leads from a node to the smallest one.
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
