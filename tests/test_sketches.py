"""Merged sketches against exact figures."""

import random

from larch.operators import sketches


def test_merged_sketches_stay_within_their_bounds(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.randint(0, 6), rng.randint(0, 4000), rng.expovariate(0.01)) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "g string, day int, who int, x double")
    days = sketches.sketches(df, ["g", "day"], "who", "x")
    got = sketches.estimates(sketches.merged(days, ["g"]), ["g"], [0.1, 0.5, 0.9]).collect()
    for r in got:
        own = sorted(x for g, _, _, x in rows if g == r.g)
        who = len({w for g, _, w, _ in rows if g == r.g})
        assert abs(r.n_distinct / who - 1) <= 0.05
        for q, x in zip((0.1, 0.5, 0.9), r.quantiles):
            assert abs(sum(v <= x for v in own) / len(own) - q) <= 0.03
    assert len(got) == 2


def test_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([("a", None, None), ("a", 1, 2.0), ("b", 3, 4.0)], "g string, who int, x double")
    got = sketches.estimates(sketches.merged(sketches.sketches(df, ["g"], "who", "x"), ["g"]), ["g"], [0.5])
    assert sorted(map(tuple, got.collect())) == [("a", 1, [2.0]), ("b", 1, [4.0])]
    assert sketches.merged(sketches.sketches(df.limit(0), ["g"], "who", "x"), ["g"]).count() == 0
