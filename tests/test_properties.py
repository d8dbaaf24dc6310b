"""Property tests: random small inputs against brute force."""

import math
from itertools import combinations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from larch.operators import baskets, counts, membership
from larch.operators.rowid import ordered_ids

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])

cells_st = st.sets(st.tuples(st.integers(0, 12), st.integers(0, 30)), min_size=1, max_size=120)


@SETTINGS
@given(keys=st.lists(st.one_of(st.none(), st.integers(-10**12, 10**12)), min_size=1, max_size=200),
       per_bucket=st.integers(2, 50))
def test_ordered_ids_rank(spark, keys, per_bucket):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, t int").repartition(3)
    got = {(r.k, r.t): r.id for r in ordered_ids(df, "k", ["t"], rows_per_bucket=per_bucket).collect()}
    order = sorted(enumerate(keys), key=lambda x: (x[1] is not None, x[1] or 0, x[0]))
    assert got == {(k, i): n for n, (i, k) in enumerate(order)}


@SETTINGS
@given(cells=cells_st, pairs=st.lists(st.tuples(st.integers(0, 14), st.integers(0, 14)), max_size=20))
def test_pair_distances(spark, cells, pairs):
    df = spark.createDataFrame(sorted(cells), "entity int, feature int")
    held = lambda e: {f for x, f in cells if x == e}
    got = {(r.a, r.b): r.distance for r in membership.pair_distances(
        df, spark.createDataFrame(pairs, "a int, b int")).collect()}
    assert got == {(a, b): len(held(a) ^ held(b)) for a, b in pairs}


@SETTINGS
@given(rows=st.lists(st.one_of(st.none(), st.lists(st.sampled_from("abcde"), max_size=5)),
                     min_size=1, max_size=40),
       support=st.sampled_from([0.1, 0.2, 0.3]))
def test_fpgrowth_itemsets(spark, rows, support):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id long, items array<string>")
    sets = [set(r) for r in rows if r is not None]
    minc = math.ceil(support * len(sets))
    want = {}
    for k in range(1, 6):
        for combo in combinations("abcde", k):
            c = sum(1 for s in sets if set(combo) <= s)
            if c >= max(minc, 1):
                want[combo] = c
    model = baskets.fit(df, support, 0.5)
    got = {tuple(r["items"]): r.freq for r in baskets.frequent_itemsets(model).collect()}
    assert got == want


@SETTINGS
@given(labels=st.lists(st.one_of(st.none(), st.sampled_from(["", " ", "a", "b", "B", "é", "a,b"])),
                       max_size=60), k=st.integers(1, 5))
def test_counts(spark, labels, k):
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    present = [x for x in labels if x is not None and x != ""]
    assert counts.present_count(df, "label").first().n == len(present)
    freq = {}
    for x in present:
        freq[x] = freq.get(x, 0) + 1
    assert [tuple(r) for r in counts.value_counts(df, "label").collect()] == sorted(freq.items())
    top = sorted(freq.items(), key=lambda kv: (-kv[1], kv[0]))[:k]
    assert [tuple(r) for r in counts.top_values(df, "label", k).collect()] == top
