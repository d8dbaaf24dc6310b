"""Windows, as-of joins and sessions over parts of a hot key, against Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from larch.operators import counts, ordered


def _rows(rng, n):
    """Half of all rows under one key; times repeat."""
    return [(rng.choice([7, 7, 7, 1, 2, 3, None]), rng.randint(0, 60), i, rng.choice([None, 1, 5, 9])) for i in range(n)]


@pytest.mark.parametrize("per_part", [3, 17, 1000])
def test_windows_equal_python(spark, per_part):
    rows = _rows(random.Random(per_part), 250)
    df = spark.createDataFrame(rows, "k int, t int, id int, v int").repartition(4)
    laid = ordered.layout(df, ["k"], ["t", "id"], per_part)
    sizes = [r["count"] for r in laid.groupBy("_part").count().collect()]
    assert max(sizes) < 2 * per_part and sum(sizes) == 250
    got = ordered.over(laid, ["k"], numbered="n", sums={"s": "v"}, before={"b": "v"}, after={"a": "id"},
                       latest={"l": "v"})
    want = {}
    for k in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == k), key=lambda r: r[1:3])
        total = latest = None
        for i, (_, _, ident, v) in enumerate(own):
            total = total if v is None else (total or 0) + v
            latest = latest if v is None else v
            want[ident] = (i + 1, total, own[i - 1][3] if i else None,
                           own[i + 1][2] if i + 1 < len(own) else None, latest)
    assert {r.id: (r.n, r.s, r.b, r.a, r.l) for r in got.collect()} == want


def test_equal_rows_fill_many_parts(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), F.lit(2).alias("t"), F.lit(3).alias("v"))
    laid = ordered.layout(df, ["k"], ["t"], 100)
    assert laid.groupBy("_part").count().agg(F.max("count")).first()[0] < 200
    got = ordered.over(laid, ["k"], numbered="n", sums={"s": "v"})
    assert sorted(tuple(r) for r in got.select("n", "s").collect()) == [(i, 3 * i) for i in range(1, 5001)]


@pytest.mark.parametrize("per_part", [4, 1000])
def test_asof_equals_python(spark, per_part):
    rng = random.Random(per_part)
    left = [(rng.choice([7, 7, 1, 2, None]), rng.choice([None, *range(40)]), i) for i in range(120)]
    right = [(rng.choice([7, 7, 1, 3, None]), rng.choice([None, *range(40)]), rng.choice([None, rng.randint(0, 9)]))
             for i in range(150)]
    got = ordered.asof_join(spark.createDataFrame(left, "k int, t int, id int"),
                            spark.createDataFrame(right, "k int, u int, v int"), ["k"], "t", "u", ["u", "v"], per_part)
    assert got.columns == ["k", "t", "id", "u", "v"]
    want = []
    for k, t, ident in left:
        near = [r[1:] for r in right if r[0] == k and k is not None and r[1] is not None
                and t is not None and r[1] <= t]
        best = max(near, key=lambda r: (r[0], r[1] is not None, r[1] or 0), default=(None, None))
        want.append((k, t, ident, *best))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == want


def test_names_of_values_may_not_clash_and_tables_may_be_empty(spark):
    left = spark.createDataFrame([(1, 2)], "k int, t int")
    right = spark.createDataFrame([], "k int, u int, v int")
    assert [tuple(r) for r in ordered.asof_join(left, right, ["k"], "t", "u", ["v"]).collect()] == [(1, 2, None)]
    assert ordered.asof_join(left.limit(0), right, ["k"], "t", "u", ["v"]).count() == 0
    with pytest.raises(ValueError):
        ordered.asof_join(left, right, ["k"], "t", "u", ["k"])


def test_sessions_over_parts(spark):
    rng, start = random.Random(3), dt.datetime(2024, 1, 1)
    rows = [(rng.choice([7, 7, 1]), start + dt.timedelta(seconds=rng.randint(0, 4000)), i) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, id int")
    got = ordered.sessions(ordered.layout(df, ["k"], ["ts", "id"], 9), ["k"], "ts", 30)
    want = {}
    for k in (1, 7):
        last, n = None, 0
        for _, ts, ident in sorted(r for r in rows if r[0] == k):
            n += last is None or (ts - last).total_seconds() > 30
            last, want[ident] = ts, n
    assert {r.id: r.session for r in got.collect()} == want


def test_grouping_tells_nulls_apart(spark):
    df = spark.createDataFrame([("x", 1), (None, 2), ("x", None)], "a string, b int")
    got = counts.grouping_sets(df, [["a"], ["b"], []], [F.count(F.lit(1)).alias("n")])
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [
        ("x", None, 1, 2), (None, None, 1, 1), (None, 1, 2, 1), (None, 2, 2, 1), (None, None, 2, 1), (None, None, 3, 3)]))
