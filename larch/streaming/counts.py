"""Per-value counts over CSV files arriving in a folder.

The same presence rule and aggregation as :func:`larch.operators.counts.value_counts`,
on a file stream: each micro-batch reads only new files, and the running
counts live in Spark's state store (checkpointed with the query).  The caller
starts the query and chooses the sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larch.functions import present


def value_counts_stream(spark: SparkSession, folder: str, schema: T.StructType, col: str,
                        encoding: str = "UTF-8", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(col, n)`` over headered CSV files in ``folder``; rows
    with the wrong number of fields are dropped."""
    reader = (spark.readStream.schema(schema)
              .option("header", True)
              .option("encoding", encoding)
              .option("mode", "DROPMALFORMED")
              # As in the batch reader: which rows are malformed must not
              # depend on the columns the query uses.
              .option("columnPruning", False))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(folder)
    return (stream.select(col).where(present(col))
            .groupBy(col).agg(F.count(F.lit(1)).alias("n")))
