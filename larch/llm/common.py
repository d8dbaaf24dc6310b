"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.sources.tables import table_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder of the session.

    ``spark.checkpoint.dir`` names it; a session without that setting uses the
    SQL warehouse, which every executor of a cluster shares as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_larch_scratch"
    return f"{root.rstrip('/')}/larch-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: cuts the
    lineage, and what is read later does not depend on any executor."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def tasks_for(rows: int, rows_per_task: int, least: int = 1) -> int:
    """Number of tasks so that each holds about ``rows_per_task`` rows."""
    return max(least, math.ceil(rows / rows_per_task))


def text_or_empty(text_col: str = "text") -> Column:
    """A null text counts as the empty text."""
    return F.coalesce(F.col(text_col), F.lit(""))
