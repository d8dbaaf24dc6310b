"""Rating prediction: a reproducible train/test split, the global mean,
user and item means with their interaction term, ALS and ALS on the
interaction term, all scored by RMSE.

Ratings are ``(userId bigint, itemId bigint, rating double)``.  Scalar
aggregates (the global mean) enter row expressions as scalar subqueries
(``DataFrame.scalar()``): Spark evaluates them once per query, with no
``collect`` in the caller and no join.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larch.functions import seeded_bucket
from larch.operators import factors
from larch.operators.rowid import ordered_ids
from larch.session import tasks_for

TRAIN, TEST = "train", "test"

# Fixed model settings of the rating tasks.
ALS_MAX_ITER = 5
ALS_RANK = 70
ALS_REG_PARAM = 0.01
ALS_COLD_START = "drop"


def with_fold(ratings: DataFrame, seed: int, train_pct: int = 80,
              keys: tuple[str, str] = ("userId", "itemId")) -> DataFrame:
    """Add ``fold`` ('train' / 'test') from an md5 bucket of
    ``seed:user:item``.

    Unlike ``randomSplit``, the fold of a row depends only on its key, not on
    partitioning, column selection or recomputation after a lost executor.
    """
    bucket = seeded_bucket(seed, *keys, buckets=100)
    return ratings.withColumn("fold", F.when(bucket < train_pct, F.lit(TRAIN)).otherwise(F.lit(TEST)))


def split(ratings: DataFrame, seed: int, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    folded = with_fold(ratings, seed, train_pct)
    train = folded.where(F.col("fold") == TRAIN).drop("fold")
    test = folded.where(F.col("fold") == TEST).drop("fold")
    return train, test


def random_split(ratings: DataFrame, seed: int,
                 train_frac: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """``DataFrame.randomSplit`` for callers who want it.  Its folds depend
    on the partitioning and the selected columns, so they are not
    reproducible across layouts; :func:`split` is."""
    train, test = ratings.randomSplit([train_frac, 1.0 - train_frac], seed=seed)
    return train, test


def fold_summary(ratings: DataFrame, seed: int, train_pct: int = 80) -> DataFrame:
    """``(fold, n, sum_user, sum_item)``: sizes and key sums of each fold."""
    return (with_fold(ratings, seed, train_pct).groupBy("fold")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.col("userId").cast("bigint")).alias("sum_user"),
                 F.sum(F.col("itemId").cast("bigint")).alias("sum_item")))


def global_mean(train: DataFrame, rating_col: str = "rating") -> DataFrame:
    return train.agg(F.avg(rating_col).alias("global_mean"))


def global_mean_value(train: DataFrame, rating_col: str = "rating") -> Column:
    """The global mean as a scalar-subquery column."""
    return train.select(F.avg(rating_col)).scalar()


def rmse(predictions: DataFrame, label: str = "rating", prediction: str = "prediction",
         digits: int | None = None) -> DataFrame:
    """``(n_scored, rmse)`` over rows with a non-NaN prediction."""
    scored = predictions.where(~F.isnan(prediction) & F.col(prediction).isNotNull())
    err = F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2)))
    if digits is not None:
        err = F.round(err, digits)
    return scored.agg(F.count(F.lit(1)).alias("n_scored"), err.alias("rmse"))


def global_mean_rmse(train: DataFrame, test: DataFrame, digits: int | None = 6) -> DataFrame:
    """Predict the training mean for every test row: ``(n_test, rmse)``."""
    predicted = test.withColumn("prediction", global_mean_value(train))
    return rmse(predicted, digits=digits).withColumnRenamed("n_scored", "n_test")


def means(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per-user and per-item training means.

    ``groupBy`` + join rather than window averages: the means must also be
    applied to the test side, and a window over an item holding a third of
    all ratings would sort that third in one task.  The joins are planned by
    size: AQE broadcasts a side only when its runtime size is under the
    broadcast threshold, otherwise sort-merge with skew splitting.
    """
    user_mean = train.groupBy("userId").agg(F.avg("rating").alias("user_mean"))
    item_mean = train.groupBy("itemId").agg(F.avg("rating").alias("item_mean"))
    return user_mean, item_mean


def with_means(rows: DataFrame, user_mean: DataFrame, item_mean: DataFrame) -> DataFrame:
    """Inner joins with both mean tables (rows of unknown users or items drop)."""
    return rows.join(item_mean, "itemId").join(user_mean, "userId")


def means_and_interaction(train: DataFrame, digits: int | None = None,
                          n: int | None = None) -> DataFrame:
    """Training rows with ``user_mean``, ``item_mean`` and
    ``user_item_interaction = rating - (user_mean + item_mean - global_mean)``,
    ordered by user and item; ``n`` keeps the first n rows (a top-n sort)."""
    user_mean, item_mean = means(train)
    gm = global_mean_value(train)
    out = with_means(train, user_mean, item_mean)
    interaction = F.col("rating") - (F.col("user_mean") + F.col("item_mean") - gm)
    cols = {"user_mean": F.col("user_mean"), "item_mean": F.col("item_mean"),
            "user_item_interaction": interaction}
    if digits is not None:
        cols = {k: F.round(v, digits) for k, v in cols.items()}
    out = (out.select("userId", "itemId", "rating",
                      *[v.alias(k) for k, v in cols.items()])
           .orderBy("userId", "itemId"))
    return out.limit(n) if n is not None else out


def als(seed: int, rating_col: str = "rating", blocks: int = 10) -> ALS:
    """ALS with the fixed settings.  ``blocks`` user and item blocks: the
    factor updates run as that many parallel tasks, so it should follow the
    cluster's parallelism (MLlib's default of 10 would not)."""
    return ALS(maxIter=ALS_MAX_ITER, rank=ALS_RANK, regParam=ALS_REG_PARAM,
               userCol="userId", itemCol="itemId", ratingCol=rating_col,
               coldStartStrategy=ALS_COLD_START, seed=seed,
               numUserBlocks=blocks, numItemBlocks=blocks)


INT_MAX = 2**31 - 1
#: Ratings of one fitting task, and the most user and item blocks of a fit.
RATINGS_PER_TASK = 1_000_000
MOST_BLOCKS = 1024


def id_index(ratings: DataFrame, col: str) -> DataFrame:
    """``(col, _ix)``: dense INT ids 0..n-1 for the distinct values of
    ``col``, numbered in key order without a single-task window.  More than
    2**31 distinct values are an error: MLlib's ALS has INT ids."""
    numbered = ordered_ids(ratings.select(col).distinct(), col, id_col="_ix")
    beyond = F.raise_error(F.lit(f"{col} has more than 2**31 distinct values; ALS ids are INT"))
    return numbered.select(col, F.when(F.col("_ix") <= INT_MAX, F.col("_ix").cast("int"))
                           .otherwise(beyond.cast("int")).alias("_ix"))


def als_ready(train: DataFrame, test: DataFrame):
    """Users and items of both folds numbered densely (one distinct and one
    numbering job each), whatever their ids.  Returns ``(train, test,
    restore)``; ``restore`` maps predictions back to the original ids."""
    cols = ("userId", "itemId")
    both = train.select(*cols).unionByName(test.select(*cols))
    indexes = {c: id_index(both, c) for c in cols}

    def to_ix(df):
        for c, ix in indexes.items():
            df = df.join(ix, c).drop(c).withColumnRenamed("_ix", c)
        return df

    def restore(df):
        for c, ix in indexes.items():
            df = df.join(ix.withColumnRenamed(c, "_orig"), df[c] == ix["_ix"]) \
                   .drop(c, "_ix").withColumnRenamed("_orig", c)
        return df
    return to_ix(train), to_ix(test), restore


def fit_als(train: DataFrame, seed: int, rating_col: str = "rating") -> factors.Factors:
    """ALS on numbered ratings, from MLlib's start by :func:`larch.operators.factors.fit`.
    The number of partitions and blocks follows the number of ratings; rows are dealt
    out by user and item, so one user's ratings are spread and repeated runs see equal
    partitions."""
    n = max(8, tasks_for(train.count(), RATINGS_PER_TASK))
    blocks = min(n, MOST_BLOCKS)
    return factors.fit(train.repartition(n, "userId", "itemId"), als(seed, rating_col, blocks))


def als_predictions(train: DataFrame, test: DataFrame, seed: int) -> DataFrame:
    """Fit ALS on ``train`` and predict ``test``; cold-start rows are dropped."""
    train, test, restore = als_ready(train, test)
    return restore(fit_als(train, seed).transform(test))


def als_rmse(train: DataFrame, test: DataFrame, seed: int, digits: int | None = None) -> DataFrame:
    """``(n_test, n_scored, rmse)`` of plain ALS."""
    scored = rmse(als_predictions(train, test, seed), digits=digits)
    return scored.select(test.select(F.count(F.lit(1))).scalar().alias("n_test"), "n_scored", "rmse")


def als_bias_predictions(train: DataFrame, test: DataFrame, seed: int) -> DataFrame:
    """Test rows with ``interaction`` (the ALS prediction of the interaction
    term) and ``prediction = interaction + user_mean + item_mean -
    global_mean``.  Rows of users or items unseen in training drop."""
    user_mean, item_mean = means(train)
    gm = global_mean_value(train)
    residual = with_means(train, user_mean, item_mean).select(
        "userId", "itemId",
        (F.col("rating") - (F.col("user_mean") + F.col("item_mean") - gm)).alias("interaction"))
    residual, test_ix, restore = als_ready(residual, test)
    model = fit_als(residual, seed, "interaction")
    pred = with_means(restore(model.transform(test_ix)), user_mean, item_mean)
    return pred.select(
        "userId", "itemId", "rating", "user_mean", "item_mean",
        F.col("prediction").alias("interaction"),
        (F.col("prediction") + F.col("user_mean") + F.col("item_mean") - gm).alias("prediction"))


def als_bias_rmse(train: DataFrame, test: DataFrame, seed: int,
                  digits: int | None = None) -> DataFrame:
    """ALS fitted on the interaction term, recomposed as
    ``prediction + user_mean + item_mean - global_mean``: ``(n_test, n_scored, rmse)``."""
    scored = rmse(als_bias_predictions(train, test, seed), digits=digits)
    return scored.select(test.select(F.count(F.lit(1))).scalar().alias("n_test"), "n_scored", "rmse")
