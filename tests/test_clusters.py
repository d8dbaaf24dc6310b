"""k-means against a plain-Python Lloyd loop with the same distance formula
and tie rule; fixed point, partition and objective invariants."""

import hashlib
import math
import random
from itertools import islice

import pytest
from pyspark.sql import functions as F

from larch import session
from larch.operators import bounded, clusters
from larch.plans import fixtures
from tests.conftest import SF_SMALL


def py_kmeans(cells, k, seed, rounds):
    sets = {}
    for e, f in cells:
        sets.setdefault(e, set()).add(f)
    order = sorted(sets, key=lambda e: (hashlib.md5(f"{seed}:{e}".encode()).hexdigest(), e))
    members = {c: [order[c]] for c in range(k)}
    history = []
    prev = None
    w = m = sq = None
    for r in range(rounds):
        new_w, new_m = [], []
        for c in range(k):
            if members[c]:
                wc = {}
                for e in members[c]:
                    for f in sets[e]:
                        wc[f] = wc.get(f, 0) + 1
                new_w.append(wc)
                new_m.append(len(members[c]))
            else:  # empty cluster keeps its previous centroid
                new_w.append(w[c])
                new_m.append(m[c])
        w, m = new_w, new_m
        sq = [sum(v * v for v in wc.values()) for wc in w]
        assign = {}
        for e, fs in sets.items():
            best = None
            for c in range(k):
                dot = sum(w[c].get(f, 0) for f in fs)
                md = float(m[c])
                d = float(len(fs)) - (2.0 * float(dot)) / md + float(sq[c]) / (md * md)
                if best is None or (d, c) < best:
                    best = (d, c)
            assign[e] = best[1]
        history.append(assign)
        if assign == prev:
            break
        prev = assign
        members = {c: [e for e, a in assign.items() if a == c] for c in range(k)}
    return order[:k], history


@pytest.fixture(scope="module")
def cells(spark):
    return fixtures.customer_brands(spark, SF_SMALL).cache()


@pytest.fixture(scope="module")
def cell_list(cells):
    return [(r.entity, r.feature) for r in cells.collect()]


def test_init_centroids(spark, cells, cell_list):
    want, _ = py_kmeans(cell_list, 4, 42, 1)
    got = [r.entity for r in clusters.init_centroids(cells, 4, 42).orderBy("cluster").collect()]
    assert got == want


def test_first_assignment(spark, cells, cell_list):
    init, history = py_kmeans(cell_list, 4, 42, 1)
    got = {r.entity: r.centroid for r in clusters.first_assignment(cells, 4, 42).collect()}
    assert got == {e: init[c] for e, c in history[0].items()}


def by_round(cells, k, seed, n):
    layout = clusters.lay_out(cells)
    init = clusters.init_centroids(cells, k, seed)
    out = []
    for kept, _ in islice(clusters.lloyd_rounds(layout, init, k), n):
        out.append({r.entity: r.cluster for r in kept.collect()})
    layout.release()
    return out


def test_rounds_match_python(spark, cells, cell_list):
    _, history = py_kmeans(cell_list, 4, 42, 4)
    assert by_round(cells, 4, 42, 4) == history


def test_converged_fixed_point(spark, cells, cell_list):
    _, history = py_kmeans(cell_list, 4, 42, 200)
    res = clusters.kmeans(cells, 4, 42)
    got = {r.entity: r.cluster for r in res.assignment.collect()}
    assert got == history[-1]
    # Every entity exactly once.
    assert res.assignment.count() == res.assignment.select("entity").distinct().count() \
        == cells.select("entity").distinct().count()
    # One more round on the converged result changes nothing.
    layout = clusters.lay_out(cells)
    again = clusters.assign(layout, clusters.centroid_stats(layout, res.assignment, 4))
    diff = again.join(res.assignment.withColumnRenamed("cluster", "c0"), "entity") \
        .where(F.col("cluster") != F.col("c0")).count()
    assert diff == 0


def test_objective_never_rises(spark, cells, cell_list):
    sets = {}
    for e, f in cell_list:
        sets.setdefault(e, set()).add(f)

    def objective(assign):
        total = 0.0
        for c in set(assign.values()):
            mem = [e for e, a in assign.items() if a == c]
            wc = {}
            for e in mem:
                for f in sets[e]:
                    wc[f] = wc.get(f, 0) + 1
            sq = sum(v * v for v in wc.values())
            for e in mem:
                dot = sum(wc.get(f, 0) for f in sets[e])
                total += len(sets[e]) - 2 * dot / len(mem) + sq / len(mem) ** 2
        return total

    values = [objective(a) for a in by_round(cells, 4, 42, 4)]
    assert all(b <= a + 1e-9 for a, b in zip(values, values[1:]))


def test_empty_cluster_keeps_centroid(spark):
    # Two identical entities chosen as centroids: ties go to the lower
    # index, so the other cluster empties and must keep its centroid.
    cells = spark.createDataFrame(
        [("a", "x"), ("b", "x"), ("c", "y"), ("d", "y"), ("d", "z")],
        "entity string, feature string")
    res = clusters.kmeans(cells, 4, 1)
    got = {r.entity: r.cluster for r in res.assignment.collect()}
    _, history = py_kmeans([tuple(r) for r in cells.collect()], 4, 1, 200)
    assert got == history[-1]


def test_hot_entity_is_salted(spark, monkeypatch):
    # One entity holds most cells: it gets several salts, results unchanged.
    rows = [("hot", f"f{i}") for i in range(400)]
    rows += [(f"e{j}", f"f{(j * 37 + i) % 400}") for j in range(40) for i in range(1 + j % 7)]
    cells = spark.createDataFrame(rows, "entity string, feature string")
    monkeypatch.setattr(clusters, "LEAST_CELLS", 50)
    layout = clusters.lay_out(cells)
    ns = {r.entity: r._ns for r in layout.entity_salts.collect()}
    assert ns["hot"] > 1 and max(v for e, v in ns.items() if e != "hot") == 1
    per_salt = layout.by_entity.where(F.col("entity") == "hot").groupBy("_salt").count().collect()
    assert len(per_salt) == ns["hot"]
    layout.release()
    _, history = py_kmeans(rows, 3, 9, 200)
    res = clusters.kmeans(cells, 3, 9)
    assert {r.entity: r.cluster for r in res.assignment.collect()} == history[-1]


def test_candidates_restrict_centroids(spark, cells):
    ents = sorted(r.entity for r in cells.select("entity").distinct().collect())
    listed = ents[::3]
    cand = spark.createDataFrame([(e,) for e in reversed(listed)], "entity long")
    got = [r.entity for r in clusters.init_centroids(cells, 4, 42, cand).orderBy("cluster").collect()]
    want = sorted(listed, key=lambda e: (hashlib.md5(f"42:{e}".encode()).hexdigest(), e))[:4]
    assert got == want


def test_k_larger_than_entities(spark):
    cells = spark.createDataFrame([("a", "x"), ("b", "y")], "entity string, feature string")
    with pytest.raises(ValueError):
        clusters.kmeans(cells, 3, 1)
    with pytest.raises(ValueError):
        clusters.first_assignment(cells, 3, 1)
    res = clusters.kmeans(cells, 2, 1)
    assert sorted(r.cluster for r in res.assignment.collect()) == [0, 1]


def test_nothing_stays_cached_but_the_result(spark):
    spark.catalog.clearCache()
    before = set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    cells = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "x")], "entity string, feature string").persist()
    cells.count()
    res = clusters.kmeans(cells, 2, 3)
    assert cells.is_cached
    assert sorted(r.cluster for r in res.assignment.collect()) in ([0, 0, 1], [0, 1, 1])
    cells.unpersist()
    assert not set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) - before
    res.release()


def test_a_cycle_is_an_error(spark, monkeypatch):
    cells = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "x"), ("c", "z")], "entity string, feature string")
    marks = iter("abcdbe")
    means = bounded.next_means

    def marked(*args):
        out = means(*args)
        out.mark, out.moved = next(marks), 1
        return out
    monkeypatch.setattr(bounded, "next_means", marked)
    with pytest.raises(RuntimeError):
        clusters.kmeans(cells, 2, 3)


def test_bounds_hold_and_most_entities_are_not_read(spark):
    """Two far groups: after the first rounds no bounds meet, and the bounds of every
    round enclose the true distances."""
    rng = random.Random(4)
    rows = {(f"{g}{e}", f"{g}{rng.randrange(12)}") for g in "ab" for e in range(40) for _ in range(6)}
    rows |= {(f"{g}{e}", f"all{g}{i}") for g in "ab" for e in range(40) for i in range(8)}
    cells = spark.createDataFrame(sorted(rows), "entity string, feature string")
    layout, k = clusters.lay_out(cells), 2
    init = spark.createDataFrame([(0, "a1"), (1, "b1")], "cluster int, entity string")
    means = bounded.first_means(layout, init, k)
    for _ in range(5):
        old, means = means, bounded.next_means(layout, means)
        if not old.rounds:
            continue
        state = means.state()
        sets = {}
        for e, f in rows:
            sets.setdefault(e, set()).add(f)
        got = state.collect()
        groups = [[r.entity for r in got if r.before == c] for c in range(k)]
        centres = [{f: sum(f in sets[e] for e in g) / len(g) for f in {f for e in g for f in sets[e]}}
                   for g in groups]

        def far(e, c):
            return math.sqrt(sum(((f in sets[e]) - c.get(f, 0)) ** 2 for f in sets[e] | set(c)))
        for r in got:
            assert far(r.entity, centres[r.cluster]) <= r.upper + 1e-6
            assert min(far(r.entity, c) for i, c in enumerate(centres) if i != r.cluster) >= r.lower - 1e-6
    still = state.where((F.col("upper") * (1 + bounded.SLACK) + bounded.SLACK) >= F.col("lower"))
    assert state.count() == 80 and still.count() == 0
    assert means.moved == 0
    layout.release()


def test_same_result_in_another_folder(spark, cells, monkeypatch):
    want = {r.entity: r.cluster for r in clusters.kmeans(cells, 4, 42).assignment.collect()}
    folder = session.storage_folder
    monkeypatch.setattr(session, "storage_folder", lambda spark: folder(spark) + "/other")
    res = clusters.kmeans(cells, 4, 42)
    assert {r.entity: r.cluster for r in res.assignment.collect()} == want
    res.release()
