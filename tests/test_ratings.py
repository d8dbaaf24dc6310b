"""Rating operators: split, means, interaction, RMSE and ALS invariants."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from larch.operators import ratings
from larch.plans import fixtures
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def rated(spark):
    return fixtures.ratings(spark, SF_SMALL).select("userId", "itemId", "rating").cache()


def test_split_covers_all_and_ignores_partitioning(spark, rated):
    train, test = ratings.split(rated, 42)
    assert train.count() + test.count() == rated.count()
    assert train.join(test, ["userId", "itemId"]).count() == 0
    a = ratings.with_fold(rated.repartition(3), 42).select("userId", "itemId", "fold")
    b = ratings.with_fold(rated.repartition(7, "itemId"), 42).select("userId", "itemId", "fold")
    assert a.exceptAll(b).count() == 0
    share = train.count() / rated.count()
    assert 0.7 < share < 0.9


def test_global_mean_and_rmse(spark, rated):
    train, test = ratings.split(rated, 42)
    tr = [r.rating for r in train.collect()]
    te = [r.rating for r in test.collect()]
    gm = sum(tr) / len(tr)
    assert ratings.global_mean(train).first().global_mean == pytest.approx(gm, abs=1e-12)
    want = math.sqrt(sum((x - gm) ** 2 for x in te) / len(te))
    row = ratings.global_mean_rmse(train, test, digits=None).first()
    assert row.n_test == len(te)
    assert row.rmse == pytest.approx(want, abs=1e-12)


def test_interaction_identity(spark, rated):
    train, _ = ratings.split(rated, 42)
    rows = ratings.means_and_interaction(train).collect()
    keys = [(r.userId, r.itemId) for r in rows]
    assert keys == sorted(keys)
    gm = sum(r.rating for r in rows) / len(rows)
    by_user = {}
    for r in rows:
        by_user.setdefault(r.userId, []).append(r)
    for user_rows in by_user.values():
        mean_i = sum(r.user_item_interaction for r in user_rows) / len(user_rows)
        mean_item = sum(r.item_mean for r in user_rows) / len(user_rows)
        assert mean_i == pytest.approx(gm - mean_item, abs=1e-9)


def test_means_join_drops_unknown(spark):
    train = spark.createDataFrame([(1, 1, 4.0), (1, 2, 2.0), (2, 1, 3.0)],
                                  "userId int, itemId int, rating double")
    test = spark.createDataFrame([(1, 1, 5.0), (3, 1, 1.0), (1, 9, 1.0)],
                                 "userId int, itemId int, rating double")
    um, im = ratings.means(train)
    got = ratings.with_means(test, um, im).select("userId", "itemId", "user_mean", "item_mean")
    assert [tuple(r) for r in got.collect()] == [(1, 1, 3.0, 3.5)]


def test_als_invariants(spark, rated):
    train, test = ratings.split(rated, 42)
    first = ratings.als_rmse(train, test, 42).first()
    again = ratings.als_rmse(train, test, 42).first()
    assert math.isfinite(first.rmse)
    assert first.rmse == pytest.approx(again.rmse, abs=1e-6)
    known = (test.join(train.select("userId").distinct(), "userId")
             .join(train.select("itemId").distinct(), "itemId"))
    assert first.n_scored == known.count()
    assert first.n_test == test.count()
    bias = ratings.als_bias_rmse(train, test, 42).first()
    assert math.isfinite(bias.rmse) and bias.n_scored == first.n_scored


def test_als_numbers_any_ids(spark):
    import random
    rnd = random.Random(3)
    rows = [(u, i, float(rnd.randint(1, 5))) for u in range(30) for i in range(12)
            if rnd.random() < 0.6]
    small = spark.createDataFrame(rows, "userId long, itemId long, rating double")
    train, test = ratings.split(small, 42)

    def widen(df):
        return df.withColumn("userId", F.col("userId") * 7 + F.lit(3 * 10**9))

    a = {(r.userId, r.itemId): r.prediction for r in ratings.als_predictions(train, test, 42).collect()}
    b = {((r.userId - 3 * 10**9) // 7, r.itemId): r.prediction
         for r in ratings.als_predictions(widen(train), widen(test), 42).collect()}
    # Numbered in key order, both give the same model.
    assert a.keys() == b.keys() and all(b[k] == pytest.approx(a[k], abs=1e-4) for k in a)


def test_als_solves_the_normal_equations(spark, rated):
    """User factors are the regularised least-squares solution given the item
    factors: the last step of a fit (the scaled ridge is MLlib's)."""
    train, test = ratings.split(rated, 42)
    numbered, _, _ = ratings.als_ready(train, test)
    # Users are solved last when the roles of users and items are swapped.
    model = ratings.fit_als(numbered, 42)
    users = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    items = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    by = {}
    for r in numbered.collect():
        by.setdefault(r.itemId, []).append((r.userId, r.rating))
    worst = min(
        max(np.abs(_solved(rows, users, ratings.ALS_REG_PARAM) - items[i]).max() for i, rows in by.items()),
        max(np.abs(_solved(rows, items, ratings.ALS_REG_PARAM) - users[u]).max()
            for u, rows in _by_user(numbered).items()))
    assert worst < 1e-3


def _by_user(numbered):
    out = {}
    for r in numbered.collect():
        out.setdefault(r.userId, []).append((r.itemId, r.rating))
    return out


def _solved(rows, factors, reg):
    x = np.array([factors[k] for k, _ in rows])
    y = np.array([v for _, v in rows])
    return np.linalg.solve(x.T @ x + reg * len(rows) * np.eye(x.shape[1]), x.T @ y)


def test_one_hot_user_is_spread(spark):
    df = spark.range(100_000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 5000).cast("int").alias("userId"),
        (F.col("id") % 997).cast("int").alias("itemId"), F.lit(3.0).alias("rating"))
    dealt = df.repartition(8, "userId", "itemId").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in dealt) < 2 * 100_000 / 8


def test_first_n_and_random_split(spark, rated):
    train, _ = ratings.split(rated, 42)
    full = ratings.means_and_interaction(train).collect()
    top = ratings.means_and_interaction(train, n=5).collect()
    assert [tuple(r) for r in top] == [tuple(r) for r in full[:5]]
    a, b = ratings.random_split(rated, 7)
    assert a.count() + b.count() == rated.count()


def test_rmse_and_recomposition(spark, rated):
    train, test = ratings.split(rated, 42)
    gm = ratings.global_mean(train).first().global_mean
    pred = ratings.als_bias_predictions(train, test, 42).cache()
    rows = pred.collect()
    for r in rows:
        assert r.prediction == pytest.approx(r.interaction + r.user_mean + r.item_mean - gm, abs=1e-9)
    want = math.sqrt(sum((r.rating - r.prediction) ** 2 for r in rows) / len(rows))
    got = ratings.rmse(pred).first()
    assert got.n_scored == len(rows)
    assert got.rmse == pytest.approx(want, abs=1e-9)
    assert ratings.als_bias_rmse(train, test, 42).first().rmse == pytest.approx(want, abs=1e-6)
    plain = ratings.als_predictions(train, test, 42).collect()
    want_plain = math.sqrt(sum((r.rating - r.prediction) ** 2 for r in plain) / len(plain))
    assert ratings.als_rmse(train, test, 42).first().rmse == pytest.approx(want_plain, abs=1e-6)


def test_als_query_returns_the_error_of_the_normal_equations(spark):
    """The registered query's RMSE against predictions from item factors and users
    solved here, on the same folds."""
    from larch.plans import oracle, queries
    from tests.oracle_compare import duck
    got = queries.als_rmse(spark, SF_SMALL).first()
    _, train, test = queries._folds(spark, SF_SMALL)
    assert tuple(got)[:2] == duck(SF_SMALL).sql(oracle.ALS_SCORED).fetchall()[0]
    numbered, wanted, _ = ratings.als_ready(train, test)
    model = ratings.fit_als(numbered, queries.SEED)
    factors = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    users = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    solved = {u: _solved(rows, factors, ratings.ALS_REG_PARAM) for u, rows in _by_user(numbered).items()}
    items = dict(factors)
    if max(np.abs(solved[u] - users[u]).max() for u in solved) > 1e-2:  # items were solved last
        solved, by = users, {}
        for r in numbered.collect():
            by.setdefault(r.itemId, []).append((r.userId, r.rating))
        items = {i: _solved(rows, users, ratings.ALS_REG_PARAM) for i, rows in by.items()}
    errors = [(r.rating - solved[r.userId] @ items[r.itemId]) ** 2 for r in wanted.collect()
              if r.userId in solved and r.itemId in items]
    assert len(errors) == got.n_scored
    assert got.rmse == pytest.approx(math.sqrt(sum(errors) / len(errors)), abs=5e-3)
    bias = queries.als_bias_rmse(spark, SF_SMALL).first()
    assert tuple(bias)[:2] == tuple(got)[:2] and math.isfinite(bias.rmse)


def _dense(spark, users, items):
    """A rating of every user for most items."""
    return (spark.range(users * items).select(
        (F.col("id") % users).cast("int").alias("userId"), (F.col("id") / users).cast("int").alias("itemId"),
        (F.pmod(F.xxhash64("id"), F.lit(5)) + 1).cast("double").alias("rating"))
        .where(F.pmod(F.xxhash64("userId", "itemId"), F.lit(4)) > 0))


def _features(df):
    return {r.id: np.array(r.features) for r in df.collect()}


@pytest.mark.parametrize("users, items", [(700, 9), (9, 700), (120, 150), (150, 120)])
def test_fit_has_the_factors_of_mllib(spark, users, items):
    rated = _dense(spark, users, items)
    doubled = rated.unionByName(rated.where("userId % 3 = 0"))
    want = ratings.als(42, blocks=8).fit(doubled.repartition(8, "userId", "itemId"))
    got = ratings.fit_als(doubled, 42)
    for a, b in ((want.userFactors, got.userFactors), (want.itemFactors, got.itemFactors)):
        a, b = _features(a), _features(b)
        assert a.keys() == b.keys()
        assert max(np.abs(a[k] - b[k]).max() for k in a) < 1e-4
    wanted = {(r.userId, r.itemId): r.prediction for r in want.transform(rated).collect()}
    found = {(r.userId, r.itemId): r.prediction for r in got.transform(rated).collect()}
    assert wanted.keys() == found.keys()
    assert max(abs(wanted[k] - found[k]) for k in wanted) < 1e-3
    unknown = spark.createDataFrame([(0, 10**6, 1.0), (10**6, 0, 1.0)], "userId int, itemId int, rating double")
    assert got.transform(unknown).count() == 0


def test_equations_are_sent_as_sums_where_items_have_many_ratings(spark):
    """A block sends an item no more than its sums, however many users rated it: factors
    of all its users would be 1,120,000 bytes an item here."""
    import pyarrow as pa

    from larch.operators import factors
    users, items = 4000, 3
    rated = pa.table({"many": np.repeat(np.arange(users, dtype=np.int32), items),
                      "few": np.tile(np.arange(items, dtype=np.int32), users),
                      "rating": np.ones(users * items, np.float32)})
    known = np.random.default_rng(1).random((users, 70), np.float32)
    sent = factors._equations(0, rated, np.arange(users, dtype=np.int32), known)
    assert sent.num_rows == items and sent.column("n").to_pylist() == [users] * items
    assert sent.nbytes < items * 21_000
