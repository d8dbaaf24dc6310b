"""Work that follows the tables: files by their bytes, lines that stay where they are."""

import glob
import os
import random
import re

from pyspark.sql import functions as F

from larch.operators import near_sets
from larch.plans import fixtures
from larch.sources.records import csv_records, kept, read_csv_records
from tests.conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_csv_files_follow_the_bytes_and_have_a_task_each(spark, monkeypatch):
    """Few but long rows are dealt over many files, and no task writes two of them."""
    table = spark.range(400).select(F.col("id").alias("k"), F.repeat(F.lit("é\n"), 500).alias("v"))
    monkeypatch.setattr(fixtures, "FILE_BYTES", 30_000)
    path = fixtures._csv_files(table, "k")
    tasks = [os.path.basename(f).split("-")[1] for f in glob.glob(path.removeprefix("file:") + "/part-*")]
    size = 400 * 1500 + sum(len(str(k)) for k in range(400))
    assert len(tasks) == len(set(tasks)) == -(-size // 30_000)
    read = kept(read_csv_records(spark, path))
    assert sorted((int(r.k), r.v) for r in read.collect()) == [(k, "é\n" * 500) for k in range(400)]


def test_records_move_no_lines_to_find_their_state(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.csv"), "w") as f:
        f.write("k,v\n1,a\n2,b\n")
    plan = plan_of(csv_records(spark, tmp_dir))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_only_like_sets_are_candidates(spark):
    """Sets that share their rarest feature and little else are out by their marks."""
    rng = random.Random(5)
    cells = {(e, f) for e in range(200) for f in [0, *rng.sample(range(1, 90), 4)]}
    cells |= {(1000 + e, f) for e in range(300) for f in range(1, 90)}
    table = spark.createDataFrame(sorted(cells), "entity long, feature int").where("entity < 1000 or feature > 0")
    found = near_sets._candidates(near_sets._prefixes(table, 1), 1).where("b < 1000")
    sharing = 200 * 199 // 2
    assert found.count() < sharing / 50


def test_lines_need_no_more_memory_with_few_shuffle_partitions(spark, monkeypatch):
    """Where the session has too few partitions for the lines, the joins make more."""
    monkeypatch.setattr(fixtures, "LINES_PER_TASK", 300)
    for table in (fixtures.customer_brands(spark, SF_SMALL), fixtures.ratings(spark, SF_SMALL)):
        dealt = re.findall(r"hashpartitioning\((\w+)#\d+L?(?:, \w+#\d+L?)?, (\d+)\), REPARTITION_BY_NUM", plan_of(table))
        assert len(dealt) == 5 and {int(n) for _, n in dealt} == {-(-spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count() // 300)}
