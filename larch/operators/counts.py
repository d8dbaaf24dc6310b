"""Counting, distinct values, top-k and overlap of one nullable column.

All of these are one hash aggregation with a map-side partial step, so a
value holding a third of the rows costs one counter per task before the
shuffle, not a third of the rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larch.functions import present


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows, column ``n``."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def present_count(df: DataFrame, col: str) -> DataFrame:
    """Number of rows whose ``col`` is present (non-NULL, non-empty)."""
    return df.agg(F.count(F.when(present(col), F.lit(1))).alias("n"))


def present_values(df: DataFrame, col: str) -> DataFrame:
    """The single column ``col``, restricted to present values."""
    return df.select(col).where(present(col))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct present values, in code-point order."""
    return present_values(df, col).distinct().orderBy(col)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``(col, n)`` for every present value, ordered by value."""
    return (present_values(df, col).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n"))
            .orderBy(col))


def top_values(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent present values: count descending, then value
    ascending, so ties have one answer.  Planned as a partial + final count
    and a ``TakeOrderedAndProject``: only k rows per task reach the driver."""
    counts = present_values(df, col).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(col)).limit(k)


def common_values(left: DataFrame, right: DataFrame, col: str) -> DataFrame:
    """Distinct present values of ``col`` found in both tables, sorted.

    ``intersect`` plans as a distinct aggregate on each side and a left-semi
    join, so neither side is expanded by duplicates.
    """
    return (present_values(left, col)
            .intersect(present_values(right, col))
            .orderBy(col))


def grouping_sets(df: DataFrame, sets: list[list[str]], measures: list) -> DataFrame:
    """The ``measures`` by each of several sets of columns, in one pass: columns that a
    set lacks are null, and ``grouping`` tells such nulls from values (one bit for each
    column, the first one highest, set where the column is left out)."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns])
    return grouped.agg(F.grouping_id().cast("bigint").alias("grouping"), *measures).select(
        *columns, "grouping", *[F.col(c) for c in _names(df, measures)])


def _names(df: DataFrame, measures: list) -> list[str]:
    return df.agg(*measures).columns
