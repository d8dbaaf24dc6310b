"""FP-Growth operators against brute-force enumeration."""

import math
from itertools import combinations

import pytest

from larch.operators import baskets
from larch.plans import fixtures
from tests.conftest import SF_SMALL

BASKETS = [
    (0, "p0", ["a", "b", "c"]), (1, "p1", ["a", "b"]), (2, "p2", ["a", "c", "a"]),
    (3, "p3", ["b", "c"]), (4, "p4", ["a"]), (5, "p5", []), (6, "p6", None),
    (7, "p7", ["a", "b", "c", "d"]), (8, "p8", ["d"]), (9, "p9", ["c", "b"]),
]


def brute(rows, support, confidence):
    sets = [set(items) for _, _, items in rows if items is not None]
    n = len(sets)
    minc = math.ceil(support * n)
    vocab = sorted(set().union(*sets))
    freq = {}
    for k in range(1, len(vocab) + 1):
        for combo in combinations(vocab, k):
            c = sum(1 for s in sets if set(combo) <= s)
            if c >= minc:
                freq[combo] = c
    rules = {}
    for items, f in freq.items():
        if len(items) < 2:
            continue
        for cons in items:
            ante = tuple(x for x in items if x != cons)
            conf = f / freq[ante]
            if conf >= confidence:
                rules[(ante, cons)] = conf
    return n, freq, rules


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(BASKETS, "id long, name string, items array<string>")


def test_itemsets_rules_interest(spark, frame):
    n, freq, rules = brute(BASKETS, 0.25, 0.5)
    model = baskets.fit(frame, 0.25, 0.5)
    got = {tuple(r["items"]): r.freq for r in baskets.frequent_itemsets(model).collect()}
    assert got == freq
    got_rules = {(tuple(r.antecedent), r.consequent[0]): r.confidence
                 for r in baskets.association_rules(model).collect()}
    assert got_rules.keys() == rules.keys()
    for key, conf in rules.items():
        assert got_rules[key] == pytest.approx(conf, abs=1e-15)
    for r in baskets.rule_interest(model, frame).collect():
        cons = r.consequent[0]
        assert r.freq == freq[(cons,)]
        assert r.interest == pytest.approx(abs(r.confidence - freq[(cons,)] / n), abs=1e-15)


def test_order_and_limit(spark, frame):
    model = baskets.fit(frame, 0.2, 0.1)
    rows = baskets.frequent_itemsets(model).collect()
    keys = [(-r.size, -r.freq, " ".join(r["items"])) for r in rows]
    assert keys == sorted(keys)
    assert [tuple(r) for r in baskets.frequent_itemsets(model, n=3).collect()] == \
        [tuple(r) for r in rows[:3]]
    rules = baskets.association_rules(model).collect()
    rkeys = [(-len(r.antecedent), -r.confidence) for r in rules]
    assert rkeys == sorted(rkeys)


def test_support_is_monotone(spark):
    b = fixtures.order_baskets(spark, SF_SMALL, "p_brand")
    model = baskets.fit(b, 0.003, 0.5)
    freq = {tuple(r["items"]): r.freq for r in baskets.frequent_itemsets(model).collect()}
    for items, f in freq.items():
        for k in range(1, len(items)):
            for sub in combinations(items, k):
                assert freq[sub] >= f


def test_basket_table_from_keyed_lines(spark):
    lines = spark.createDataFrame([(30, "c,x,y"), (10, "a,y"), (20, "b")], "key long, value string")
    got = [(r.id, r.name, list(r["items"])) for r in baskets.basket_table(lines, key="key").collect()]
    assert got == [(0, "a", ["y"]), (1, "b", []), (2, "c", ["x", "y"])]
    assert baskets.basket_table(lines, key="key", n=2).count() == 2


def test_empty_and_null_baskets(spark):
    for rows in ([], [(1, "x", None), (2, "y", None)]):
        df = spark.createDataFrame(rows, "id long, name string, items array<string>")
        model = baskets.fit(df, 0.3, 0.5)
        assert baskets.frequent_itemsets(model).count() == 0
        assert baskets.association_rules(model).count() == 0
        assert baskets.rule_interest(model, df).count() == 0
