import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from larch.llm import negatives
from larch.llm.queries import ORACLE, op11_hard_negatives

from tests.conftest import SF_CHECK, SF_SMALL


def brute(rows, every=3, positives=5, k=10):
    """Rows ``(id, label, vector)`` with whole components."""
    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    result = []
    for a in {r[0]: r for r in rows if r[0] % every == 0}.values():
        near = sorted((-dot(a[2], r[2]), r[0]) for r in rows if r[1] == a[1] and r[0] != a[0])
        for p, (score, positive) in enumerate(near[:positives]):
            score = -score
            far = sorted((-dot(a[2], r[2]), r[0]) for r in rows if r[1] != a[1]
                         and 30 * score <= 100 * dot(a[2], r[2]) <= 90 * score)
            result += [(a[0], positive, i + 1, n, score, -s) for i, (s, n) in enumerate(far[:k])]
    return sorted(result)


def _mined(spark, rows, every=3, **settings):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(3)
    found = negatives.hard_negatives(frame, F.col("vec_id") % every == 0, scale=1.0, **settings)
    return sorted(tuple(r) for r in found.collect())


def _rows(rng, n, width, most=6, labels=3):
    return [(i, rng.randrange(labels), [float(rng.randint(-most, most)) for _ in range(width)])
            for i in range(n)]


def test_results_equal_brute_force(spark):
    rng = random.Random(5)
    rows = _rows(rng, 120, 4) + [(i, 1, [3.0, 0.0, -2.0, 5.0]) for i in range(200, 240)]
    rows += [(300, 0, [0.0] * 4), (301, 1, [0.0] * 4), (303, 0, [0.0] * 4)]
    want = brute(rows)
    assert len(want) > 500
    assert _mined(spark, rows) == want


def test_batches_blocks_and_short_steps_change_nothing(spark, monkeypatch):
    rows = _rows(random.Random(6), 150, 3)
    want = brute(rows, 10)
    monkeypatch.setattr(negatives, "BATCH_COMPONENTS", 12)
    assert _mined(spark, rows, 10) == want


@pytest.mark.parametrize("spread", [0.05, 0.5, 3.0])
def test_walk_ends_early_and_loses_nothing(monkeypatch, spread):
    monkeypatch.setattr(negatives, "FIRST_ROWS", 8)
    monkeypatch.setattr(negatives, "MOST_ROWS", 32)
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((6, 16))
    rows = np.floor(256 * (centres[np.arange(3000) % 6] + spread * rng.standard_normal((3000, 16))))
    ids, labels = np.arange(3000), np.arange(3000) % 2
    anchors = rows[:30]
    wanted = negatives.Wanted(ids[:30], labels[:30], anchors, negatives.Clusters(anchors), np.arange(30),
                              np.zeros(30), np.full(30, -2**63), np.full(30, 2**63 - 1), 5, True)
    best = negatives._Best(wanted)
    computed = sum(negatives.walk(wanted, best, ids[i:i + 500], labels[i:i + 500], rows[i:i + 500])
                   for i in range(0, 3000, 500))
    scores = anchors @ rows.T
    for a in range(30):
        order = [i for i in np.lexsort((ids, -scores[a])) if labels[i] == labels[a] and i != a][:5]
        assert best.ids[a].tolist() == order
    if spread < 0.1:
        assert computed < 30 * 3000 / 3


def test_large_components_are_exact(spark):
    rng = random.Random(8)
    rows = [(i, i % 2, [float(rng.randint(-2**30, 2**30)) for _ in range(2)]) for i in range(40)]
    exact = [(i, lab, [int(x) for x in v]) for i, lab, v in rows]
    assert _mined(spark, rows) == brute(exact)


def test_odd_rows(spark):
    good = _rows(random.Random(9), 60, 3)
    odd = [(None, 1, [1.0] * 3), (63, None, [1.0] * 3), (66, 1, None), (69, 1, [1.0, None, 2.0]),
           (72, 1, [float("nan"), 0.0, 0.0]), (75, 1, [float("inf"), 0.0, 0.0]), (78, 1, [1e300, 0.0, 0.0])]
    short = [(81, 1, [2.0]), (82, 2, []), (84, 0, [1.0, 2.0])]
    assert _mined(spark, good + odd + short) == brute(good + short)
    # A repeated row is a candidate of its own and one anchor.
    twice = good + [good[3], good[7]]
    assert _mined(spark, twice) == brute(twice)
    assert _mined(spark, []) == []
    assert _mined(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == []


def test_clashing_columns_and_scale(spark):
    frame = spark.createDataFrame(
        [(0, 0, [0.5, 0.1], "a", 1.0), (1, 0, [0.5, 0.1], "b", 2.0), (2, 1, [0.3, 0.1], "c", 3.0)],
        "vec_id long, label int, embedding array<float>, id string, score double")
    found = negatives.hard_negatives(frame, F.col("vec_id") == 0)
    # 128 * 128 + 25 * 25 and 128 * 76 + 25 * 25
    assert [tuple(r) for r in found.collect()] == [(0, 1, 1, 2, 17009, 10353)]


@pytest.mark.parametrize("folder", [SF_SMALL, SF_CHECK])
def test_query_equals_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = con.sql(ORACLE["op11_hard_negatives"]).fetchall()
    found = op11_hard_negatives(spark, folder)
    assert found.columns == con.sql(ORACLE["op11_hard_negatives"]).columns
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert want
