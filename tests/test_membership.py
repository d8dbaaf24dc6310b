"""Membership, lookups and distances of stated pairs against brute force."""

import random
from itertools import combinations

from larch.operators import membership


def sample_cells(seed=7, n_entities=23, n_features=60, density=0.2, hot=True):
    rnd = random.Random(seed)
    cells = set()
    for e in range(n_entities):
        for f in range(n_features):
            if rnd.random() < density:
                cells.add((f"e{e:02d}", f"f{f}"))
    if hot:  # one feature held by every entity, one entity holding every feature
        cells |= {(f"e{e:02d}", "f_hot") for e in range(n_entities)}
        cells |= {("e00", f"f{f}") for f in range(n_features)}
    cells.add(("e_lonely", "f_unique"))
    return sorted(cells)


def brute_distances(cells):
    sets = {}
    for e, f in cells:
        sets.setdefault(e, set()).add(f)
    return {(a, b): len(sets[a] ^ sets[b]) for a, b in combinations(sorted(sets), 2)}


def test_pair_distances_of_stated_pairs(spark):
    cells = sample_cells()
    df = spark.createDataFrame(cells, "entity string, feature string")
    want = brute_distances(cells)
    pairs = spark.createDataFrame(sorted(want) + [("e05", "e01"), ("e02", "e02"), ("e00", "nobody"), ("e00", "nobody")],
                                  "a string, b string")
    got = {(r.a, r.b): r.distance for r in membership.pair_distances(df, pairs).collect()}
    want |= {("e05", "e01"): want["e01", "e05"], ("e02", "e02"): 0,
             ("e00", "nobody"): sum(e == "e00" for e, _ in cells)}
    assert got == want


def test_lookups_of_stated_probes(spark):
    cells = sample_cells(seed=3)
    df = spark.createDataFrame(cells, "entity string, feature string")
    probes = [("e_lonely", "f_unique"), ("e_lonely", "f_hot"), ("nobody", "f_hot"), ("e01", "no feature"), ("e01", "f_hot")]
    got = {(r.entity, r.feature): r.present for r in membership.lookups(
        df, spark.createDataFrame(probes, "entity string, feature string")).collect()}
    assert got == {p: p in set(cells) for p in probes}


def test_pair_distance_and_lookup(spark):
    cells = sample_cells(seed=3)
    df = spark.createDataFrame(cells, "entity string, feature string")
    want = brute_distances(cells)
    assert membership.pair_distance(df, "e01", "e05").first().distance == want[("e01", "e05")]
    assert membership.pair_distance(df, "e05", "e01").first().distance == want[("e01", "e05")]
    assert membership.pair_distance(df, "e05", "e05").first().distance == 0
    assert membership.lookup(df, "e_lonely", "f_unique").first().present is True
    assert membership.lookup(df, "e_lonely", "f_hot").first().present is False
    assert membership.lookup(df, "nobody", "f_hot").first().present is False


def test_membership_sets(spark):
    cells = sample_cells(seed=5, n_entities=9, n_features=13)
    df = spark.createDataFrame(cells, "entity string, feature string")
    feats = {f for _, f in cells}
    sets = {(r.entity, r.n_features, r.n_absent) for r in membership.membership_sets(df).collect()}
    for e in {e for e, _ in cells}:
        n = sum(1 for x, _ in cells if x == e)
        assert (e, n, len(feats) - n) in sets


def test_membership_from_baskets(spark):
    b = spark.createDataFrame([("rosa", ["qc", "on", "qc"]), ("abies", [])],
                              "name string, items array<string>")
    got = sorted(tuple(r) for r in membership.membership_from_baskets(b).collect())
    assert got == [("on", "rosa"), ("qc", "rosa")]
