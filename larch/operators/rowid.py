"""Dense 0-based row ids without an unpartitioned window.

``row_number()`` over a window with no partition key moves every row into
one task.  Both functions here keep the work spread over all tasks; only the
row count of each partition comes to the driver.  The numbered layout is stored
(:func:`larch.session.stored`), since ids must not change when a task is run
again; the stored copy belongs to the session.

* :func:`line_ids` numbers the lines of text files by position.
* :func:`ordered_ids` numbers the rows of a table in the order of a key.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larch.session import stored, tasks_for

_POS_BITS = 33  # monotonically_increasing_id = (partition << 33) + position


def position() -> Column:
    """The place of a row within its partition."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POS_BITS) - 1))


def _numbered(tagged: DataFrame, counts: dict[int, int], id_col: str) -> DataFrame:
    """Adds the id: rows of earlier partitions, then the position."""
    last = max(counts, default=-1)
    sizes = [counts.get(p, 0) for p in range(last + 1)]
    offsets = [0, *accumulate(sizes)][:-1] or [0]
    # One folded constant, as long as the number of partitions.
    table = F.split(F.lit(",".join(map(str, offsets))), ",").cast("array<bigint>")
    return tagged.withColumn(id_col, F.get(table, F.col("_part")) + F.col("_pos")).drop("_part", "_pos")


def _partition_counts(tagged: DataFrame) -> dict[int, int]:
    return {r["_part"]: r["_n"] for r in
            tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).collect()}


def block_columns(lines: DataFrame) -> list[Column]:
    """``_file`` and ``_block``: the file and the first byte of the split that a line of
    ``spark.read.text(path)`` comes from.  A task's splits follow one another."""
    return [F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block")]


def line_ids(lines: DataFrame, id_col: str = "id") -> DataFrame:
    """Add ``id`` = line number - 1 to ``spark.read.text(path)``, a file or a folder.

    Several files are numbered one after another in the order of their paths,
    as if they were one.  The files are read once: every line is stored with its
    split and its place, so the counts and the ids see the same splits however many
    executors there are.  The driver adds up one row per split.  Lines that do
    not come from files are numbered by partition.
    """
    if not lines.inputFiles():
        tagged, _ = stored(lines.select(
            "*", F.spark_partition_id().alias("_part"), position().alias("_pos")))
        return _numbered(tagged, _partition_counts(tagged), id_col)
    tagged, _ = stored(lines.select("*", *block_columns(lines), position().alias("_pos")))
    splits = (tagged.groupBy("_file", "_block")
              .agg(F.count(F.lit(1)).alias("n"), F.min("_pos").alias("first"))
              .orderBy("_file", "_block").collect())
    before = [0, *accumulate(s["n"] for s in splits)]
    starts = lines.sparkSession.createDataFrame(
        [(s["_file"], s["_block"], at - s["first"]) for s, at in zip(splits, before)],
        "_file string, _block bigint, _start bigint")
    return (tagged.join(starts, ["_file", "_block"])
            .withColumn(id_col, F.col("_start") + F.col("_pos"))
            .drop("_file", "_block", "_start", "_pos"))


def ordered_ids(df: DataFrame, key: str, tie_cols: Sequence[str] = (),
                rows_per_bucket: int = 2_000_000, id_col: str = "id") -> DataFrame:
    """Add ``id`` = 0-based position of the row in ``(key, *tie_cols)`` order,
    null keys first.

    Rows are range-partitioned by key, tie columns, a hash of the row and its
    place in the input, so that neither a repeated key nor a repeated row has
    to stay in one partition.  Partitions hold fewer than twice
    ``rows_per_bucket`` rows: their counts are checked, and the range is cut
    finer while one is larger.  Rows equal in key and tie columns are numbered
    by the hash of all columns.
    """
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields
              if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = ["_key", *[f"_tie{i}" for i in range(len(tie_cols))], "_hash", "_place"]
    keyed = df.select(
        "*", F.col(key).alias("_key"), *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie_cols)],
        F.xxhash64(*hashed).alias("_hash"), F.monotonically_increasing_id().alias("_place"))
    parts = tasks_for(df.count(), rows_per_bucket)
    while True:
        tagged, drop = stored(
            keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
            .withColumn("_part", F.spark_partition_id()).withColumn("_pos", position())
            .drop(*order))
        counts = _partition_counts(tagged)
        if max(counts.values(), default=0) < 2 * max(2, rows_per_bucket):
            return _numbered(tagged, counts, id_col)
        drop()
        parts *= 2
