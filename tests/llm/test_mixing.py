"""Soft-membership mixing: targets met, against a dense solver."""

import numpy as np
import pytest

from larch.llm import mixing, queries

SF = "/root/testdata/sf0.01"


def test_query_meets_targets(spark):
    rows = queries.QUERIES["op3_soft_mixing"](spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    n = np.array([r.n_tokens for r in rows], float)
    assert [r.n_tokens for r in rows] == [len(docs[r.doc_id].text.encode().split()) for r in rows]
    p = np.array([[r.p_high, r.p_low, r.p_toxic] for r in rows])
    rate = np.array([r.rate for r in rows])
    assert np.allclose(p.sum(1), 1) and (rate >= 0).all()
    share = (rate * n) @ p / n.sum()
    assert np.abs(share - [mixing.DOMAIN_TARGETS[d] for d in ("high", "low", "toxic")]).max() <= 2e-4
    copies = np.array([r.copies for r in rows])
    assert (np.abs(copies - rate) < 1).all() and abs(copies.mean() - rate.mean()) < 0.1


def test_posteriors_tell_the_domains(spark):
    labels = {r.doc_id: ("toxic" if r.toxic else "high" if r.quality else "low")
              for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op3_soft_mixing"](spark, SF).collect() if r.doc_id in labels]
    mean = lambda c, d: np.mean([r[c] for r in rows if labels[r.doc_id] == d])
    for d in ("high", "low", "toxic"):
        assert mean(f"p_{d}", d) > max(mean(f"p_{d}", o) for o in ("high", "low", "toxic") if o != d)


def table(spark, n, p):
    return spark.createDataFrame([(int(a), [float(x) for x in q]) for a, q in zip(n, p)],
                                 "n_tokens long, posterior array<double>")


@pytest.mark.parametrize("targets", [(0.5, 0.3, 0.2), (0.2, 0.2, 0.6)])
def test_least_squares(spark, targets):
    rng = np.random.default_rng(4)
    p = rng.dirichlet((1.5, 1.0, 0.3), 400)
    n = rng.integers(0, 500, 400)
    df = table(spark, n, p)
    fit = mixing.fit_rates(df, ("a", "b", "c"), dict(zip("abc", targets)))
    rate = np.array([r[0] for r in df.select(fit.rate()).collect()])
    assert (rate >= 0).all()
    share = (rate * n) @ p / n.sum()
    # A plain long run of the same problem on the driver.
    w = np.linalg.inv((p * n[:, None]).T @ p / n.sum())
    x = np.ones(400)
    for _ in range(100000):
        x = np.maximum(0, x - p @ (w @ ((x * n) @ p / n.sum() - targets)))
    best = (x * n) @ p / n.sum() - targets
    got = share - targets
    assert got @ w @ got <= best @ w @ best + 1e-6


def test_targets_out_of_reach(spark):
    p = np.array([[0.6, 0.4], [0.55, 0.45]] * 10)
    n = np.arange(1, 21)
    df = table(spark, n, p)
    fit = mixing.fit_rates(df, ("a", "b"), {"a": 1.0})
    rate = np.array([r[0] for r in df.select(fit.rate()).collect()])
    assert (rate >= 0).all() and (rate[1::2] < rate[::2].min() + 1e-9).all()


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, " \n", 9), (None, "a b", 9), (4, "x " * 50000, 9),
                                  (4, "x " * 50000, 9)], "doc_id long, text string, n_tokens int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = mixing.learn(docs, none, mixing.label_domain())
    assert model.domains == ()
    told = mixing.with_posteriors(docs, model)
    assert [r.n_tokens for r in told.collect()] == [0, 0, 0, 2, 50000, 50000]
    assert mixing.fit_rates(told, model.domains, {"high": 1.0}).steps == []
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (4, None, None), (None, 1, 1), (77, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    model = mixing.learn(docs, labels, mixing.label_domain())
    told = mixing.with_posteriors(docs, model)
    assert [r.n_tokens for r in told.collect()] == [0, 0, 0, 2, 50000, 50000]
    fit = mixing.fit_rates(told, model.domains, {"high": 0.5, "low": 0.5, "absent": 3})
    assert all(r[0] >= 0 for r in told.select(fit.rate()).collect())
    assert mixing.fit_rates(told.limit(0), model.domains, {"high": 1.0}).steps == []
