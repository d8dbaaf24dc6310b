"""Parallel row ids equal the sequential row number."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from larch.operators.rowid import line_ids, ordered_ids


def wanted(df, *order):
    return df.withColumn("want", F.row_number().over(Window.orderBy(*order)) - 1)


@pytest.mark.parametrize("per_bucket", [2, 100])
def test_null_and_repeated_keys_small(spark, per_bucket):
    rows = [(5, "a"), (None, "b"), (1, "c"), (9, "d"), (7, "e"), (1, "f"), (1, "a"), (None, "a")]
    df = spark.createDataFrame(rows, "k long, t string").repartition(3)
    got = ordered_ids(df, "k", ["t"], rows_per_bucket=per_bucket)
    ids = wanted(got, "k", "t").collect()
    assert len(ids) == len(rows) and all(r.id == r.want for r in ids)
    assert ids[0].k is None


def test_many_keys_and_one_hot_key(spark):
    df = spark.range(0, 120_000).select(
        F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 3 == 0, 7).otherwise(
            F.col("id") * 7919 % 100_003).alias("k"), F.col("id").alias("t")).repartition(7)
    got = ordered_ids(df, "k", ["t"], rows_per_bucket=2000).cache()
    assert got.count() == 120_000
    assert wanted(got, "k", "t").where("id <> want").count() == 0
    got.unpersist()


def test_buckets_stay_under_twice_the_size(spark, monkeypatch):
    from larch.operators import rowid
    seen = []
    counts = rowid._partition_counts
    monkeypatch.setattr(rowid, "_partition_counts", lambda t: seen.append(counts(t)) or seen[-1])
    df = spark.range(0, 100_000).select(F.lit(1).alias("k"))
    got = ordered_ids(df, "k", rows_per_bucket=1000)
    assert max(seen[-1].values()) < 2000
    assert got.agg(F.count_distinct("id"), F.max("id")).first() == (100_000, 99_999)


def test_ids_are_dense_from_many_splits(spark, tmp_dir):
    path = f"{tmp_dir}/lines.txt"
    with open(path, "w") as f:
        f.write("".join(f"line {i}\n" for i in range(50_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = line_ids(spark.read.text(path))
        assert got.where(F.concat(F.lit("line "), F.col("id")) != F.col("value")).count() == 0
        assert got.count() == 50_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_ordered_ids_empty(spark):
    df = spark.createDataFrame([], "k long")
    assert ordered_ids(df, "k").count() == 0
