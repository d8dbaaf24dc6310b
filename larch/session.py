"""Session helpers for tests, the benchmark and scripts, and storage for
intermediate results.

The library itself never builds a session; operators take DataFrames.
"""

from __future__ import annotations

import math
import os
import uuid
import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "larch", checkpoint_dir: str | None = None) -> SparkSession:
    """A local session configured like the test and benchmark runs."""
    parts = shuffle_partitions or cores
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LARCH_DRIVER_MEMORY", "10g"))
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def storage_folder(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.  Where it is unset, a
    local session (as in tests) uses a folder in its warehouse; a session on several
    machines has no folder that all of them surely see, which is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_larch").rstrip("/")


def new_folder(spark: SparkSession, name: str = "data") -> str:
    """A new folder name in the shared folder."""
    return f"{storage_folder(spark)}/larch-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """``df`` written as Parquet to the shared folder and read again, and a
    function that deletes the copy.

    The lineage is cut, and no executor has to survive for the copy.  What an
    operator stores for its result belongs to the folder's owner; what it no
    longer needs, it deletes itself.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.parquet(path)

    def drop() -> None:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

    return spark.read.schema(df.schema).parquet(path), drop


def releasing(result: DataFrame, *cached: DataFrame) -> DataFrame:
    """``result``; the cached frames it reads are uncached when nobody holds it
    any more.  A frame derived from it still computes, from the lineage."""
    def release() -> None:
        for frame in cached:
            try:
                frame.unpersist()
            except Exception:  # the session has ended and taken its frames along
                return
    weakref.finalize(result, release).atexit = False
    return result


def tasks_for(rows: int, rows_per_task: int) -> int:
    """Tasks of about ``rows_per_task`` rows each, however many cores there are."""
    return max(1, math.ceil(rows / rows_per_task))
