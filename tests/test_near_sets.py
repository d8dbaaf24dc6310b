"""Near sets against all pairs of a small table."""

import random

import pytest
from pyspark.sql import functions as F

from larch.operators import near_sets


def brute(cells, radius):
    sets = {}
    for e, f in cells:
        sets.setdefault(e, set()).add(f)
    classes = {e: min(o for o in sets if sets[o] == sets[e]) for e in sets}
    reps = sorted(e for e in sets if classes[e] == e)
    pairs = sorted((a, b, len(sets[a] ^ sets[b])) for i, a in enumerate(reps) for b in reps[i + 1:]
                   if len(sets[a] ^ sets[b]) <= radius)
    near = {e: sum(o != e and len(sets[o] ^ sets[e]) <= radius for o in sets) for e in sets}
    return classes, pairs, near


def _cells(rng, n, features, most):
    hot = rng.sample(range(features), 3)
    rows = set()
    for e in range(n):
        k = rng.randint(1, most)
        own = hot if e % 3 == 0 else rng.sample(range(features), min(k, features))
        own = set(own)
        if e % 5 == 0:
            own ^= {rng.randrange(features)}
        rows |= {(e, f) for f in own}
    return sorted(rows)


@pytest.mark.parametrize("radius,features,most", [(0, 9, 5), (1, 9, 5), (2, 12, 6), (3, 12, 4), (5, 30, 9)])
def test_equals_all_pairs(spark, radius, features, most):
    cells = _cells(random.Random(radius), 120, features, most)
    near = near_sets.within_distance(spark.createDataFrame(cells, "entity long, feature int"), radius)
    classes, pairs, counts = brute(cells, radius)
    assert {r.entity: r["class"] for r in near.classes.collect()} == classes
    assert sorted(map(tuple, near.pairs.collect())) == pairs
    got = {r.entity: r.n_near for r in near_sets.near_counts(near).collect()}
    assert got == counts and sum(got.values()) > 0


def test_equal_hashes_of_unequal_sets_stand_alone(spark, monkeypatch):
    cells = [(1, 10), (2, 11), (3, 10), (4, 12)]
    monkeypatch.setattr(near_sets.F, "xxhash64", lambda *c: F.lit(0).cast("long"))
    near = near_sets.within_distance(spark.createDataFrame(cells, "entity long, feature int"), 2)
    assert {r.entity: r["class"] for r in near.classes.collect()} == {1: 1, 2: 2, 3: 1, 4: 4}
    assert sorted(map(tuple, near.pairs.collect())) == [(1, 2, 2), (1, 4, 2), (2, 4, 2)]


def test_odd_cells(spark):
    cells = spark.createDataFrame([(1, None, 5), (None, 2, 5), (3, 2, 5)], "entity long, feature int, a int")
    near = near_sets.within_distance(cells, 3)
    assert [tuple(r) for r in near_sets.near_counts(near).collect()] == [(3, 3, 0)]
    assert near_sets.near_counts(near_sets.within_distance(cells.limit(0), 3)).count() == 0
    with pytest.raises(ValueError):
        near_sets.within_distance(cells, -1)


def test_candidates_stay_few_with_a_hot_feature(spark):
    """Every set holds the hot feature; only the rare ones bring sets together."""
    cells = spark.range(4000).select(
        F.col("id").alias("entity"),
        F.explode(F.array(F.lit(0), 1 + F.col("id") % 1999, 2000 + F.col("id") * 7 % 1999)).alias("feature"))
    prefixes = near_sets._prefixes(cells, 1)
    assert near_sets._candidates(prefixes, 1).count() < 50_000
