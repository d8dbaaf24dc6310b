"""Records of CSV files cut at their true ends by every split, and their account."""

import csv
import os
import random

import numpy as np
import pytest

from larch.sources import records as R

PIECES = ["a", "b c", "", '"', "\n", ",", "\n\n", "x\ny", '""', " ", "é", "5\" pipe"]


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _write(folder, name, rows, end="\n", quoting=csv.QUOTE_MINIMAL, encoding="utf-8"):
    path = os.path.join(folder, name)
    with open(path, "w", newline="", encoding=encoding) as f:
        out = csv.writer(f, lineterminator=end, quoting=quoting)
        out.writerow(["k", "v", "w"])
        out.writerows(rows)
    return path


def _one_task(spark, path, schema, **options):
    """The reader that gives each file to one task."""
    return (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_malformed")
            .option("columnPruning", False).options(**options).schema(schema + ", _malformed string").csv(path))


def _made(rng, n):
    return [[i, "".join(rng.choices(PIECES, k=rng.randint(0, 6))),
             "".join(rng.choices(PIECES, k=rng.randint(0, 30 if i % 17 == 0 else 3)))] for i in range(n)]


@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
def test_equals_the_one_task_reader_over_many_splits(spark, tmp_dir, small_splits, quoting):
    rng = random.Random(1)
    for name, n in (("b.csv", 300), ("a.csv", 40), ("c.csv", 1)):
        _write(tmp_dir, name, _made(rng, n), quoting=quoting)
    got = R.read_csv_records(spark, tmp_dir)
    assert spark.read.text(tmp_dir).rdd.getNumPartitions() > 10
    want = _one_task(spark, tmp_dir, "k string, v string, w string").drop("_malformed")
    assert got.columns == ["k", "v", "w", "_malformed", "_file", "_line"]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, R.kept(got).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    assert R.dropped(got).count() == 0


def test_record_longer_than_many_splits(spark, tmp_dir, small_splits):
    path = _write(tmp_dir, "long.csv", [[1, "x\n" * 2000, "y"], [2, "a", "b"]])
    assert [tuple(r) for r in R.csv_records(spark, path).orderBy("line").select("line", "record").collect()] == [
        (0, "k,v,w"), (1, '1,"' + "x\n" * 2000 + '",y'), (2002, "2,a,b")]


def test_line_ends_encoding_and_mark(spark, tmp_dir, small_splits):
    rows = [[1, "é\nè", "x"], [2, "ü", "y"]]
    path = _write(tmp_dir, "crlf.csv", rows, end="\r\n", encoding="latin-1")
    got = R.kept(R.read_csv_records(spark, path, encoding="ISO-8859-1"))
    assert sorted(map(tuple, got.collect())) == [("1", "é\nè", "x"), ("2", "ü", "y")]
    path = _write(tmp_dir, "mark.csv", rows, encoding="utf-8-sig")
    assert R.read_csv_records(spark, path).columns[:3] == ["k", "v", "w"]
    with pytest.raises(ValueError):
        R.csv_records(spark, path, encoding="UTF-16")


def test_account_adds_up_and_equals_the_reader(spark, tmp_dir, small_splits):
    rng = random.Random(2)
    path = os.path.join(tmp_dir, "bad.csv")
    rows = ["1,a,2", "x,b,3", "2,c", "3,d,4,5", '4,"e\nf",6', '5,"g ""h""\n",7', "", "6,,", "   ", '7,"un"q,8']
    text = "\n".join(rng.choices(rows, k=400))
    with open(path, "w") as f:
        f.write("k,v,w\n" + text + "\n")
    schema = spark.createDataFrame([], "k int, v string, w int").schema
    got = R.read_csv_records(spark, path, schema).cache()
    n, kept, dropped = R.account(got).first()
    assert n == kept + dropped and R.kept(got).count() == kept and R.dropped(got).count() == dropped
    want = _one_task(spark, path, "k int, v string, w int").cache()
    assert n == want.count()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, R.kept(got).collect()), key=key) == sorted(
        map(tuple, want.where("_malformed IS NULL").drop("_malformed").collect()), key=key)
    assert dropped == want.where("_malformed IS NOT NULL").count() > 100
    # A dropped record names its line.
    lines = ("k,v,w\n" + text).split("\n")
    for r in R.dropped(got).collect():
        assert lines[r["line"] - 1] == r["record"].split("\n")[0]
    got.unpersist()
    want.unpersist()


def test_empty_inputs(spark, tmp_dir):
    path = _write(tmp_dir, "head.csv", [])
    got = R.read_csv_records(spark, path)
    assert got.columns[:3] == ["k", "v", "w"] and R.account(got).first()[:] == (0, 0, 0)
    open(os.path.join(tmp_dir, "none.csv"), "w").close()
    assert R.csv_records(spark, os.path.join(tmp_dir, "none.csv")).count() == 0


def test_names_of_the_account_are_refused(spark, tmp_dir):
    path = _write(tmp_dir, "x.csv", [])
    with pytest.raises(ValueError):
        R.read_csv_records(spark, path, spark.createDataFrame([], "_line int").schema)
    with pytest.raises(ValueError):
        R.csv_records(spark, path, sep="::")


def test_states_in_batches_equal_one_by_one():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(0, 30))
        outside, inside = rng.random(n) < 0.4, rng.random(n) < 0.5
        for first in (False, True):
            state, start, want = first, -1, []
            for i in range(n):
                start = start if state else i
                state = bool(inside[i] if state else outside[i])
                want.append((start, state))
            walk, got, at = R._Walk(first), [], 0
            while at < n:
                step = int(rng.integers(1, 8))
                starts, after = walk.lines(at, outside[at:at + step], inside[at:at + step])
                got += list(zip(starts.tolist(), after.tolist()))
                at += step
            assert got == want
