"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the
whole driver tables.  Computed columns carry the same names as in
:mod:`larch.plans.oracle`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.operators import baskets, clusters, counts, membership, near_sets, ordered, ratings, sketches
from larch.plans import fixtures
from larch.session import releasing
from larch.sources import (account, csv_lines, kept, parse_ratings, read_csv_records, read_csv_table,
                           read_lines, read_table)

Query = Callable[[SparkSession, str], DataFrame]

LABEL = "label"
SEED = 42


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.row_count(fixtures.labelled(spark, sf_dir))


def present_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.present_count(fixtures.labelled(spark, sf_dir), LABEL)


def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.distinct_values(fixtures.labelled(spark, sf_dir), LABEL)


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.value_counts(fixtures.labelled(spark, sf_dir), LABEL)


def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.top_values(fixtures.labelled(spark, sf_dir), LABEL, k=10)


def common_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.common_values(fixtures.period_customers(spark, sf_dir, 1995),
                                fixtures.period_customers(spark, sf_dir, 1996),
                                "c_name")


def csv_line_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_lines(value_counts(spark, sf_dir))


def parse_rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_ratings(fixtures.rating_lines(spark, sf_dir))


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read_csv_table(spark, fixtures.part_files(spark, sf_dir), fixtures.PART_FIELDS)
    return parts.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size"), F.max("p_name").alias("last_name"))


def csv_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return account(read_csv_records(spark, fixtures.part_files(spark, sf_dir), fixtures.PART_FIELDS))


def csv_quoted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = kept(read_csv_records(spark, fixtures.document_files(spark, sf_dir)))
    return records.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang",
                          F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5"))


def file_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_lines(spark, fixtures.basket_files(spark, sf_dir))
    return baskets.basket_table(lines).select("id", "name", _joined("items"))


def _ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.ratings(spark, sf_dir).select("userId", "itemId", "rating")


def _folds(spark: SparkSession, sf_dir: str):
    """Train and test folds over one cached copy of the rated rows.

    The rating queries read the folds from several branches (the means,
    the global mean, the model fit).  Their subplans differ in the null
    filters Catalyst infers from each join key, so exchange reuse does not
    apply; caching the folded ratings computes the three-way join and the
    md5 fold once.  A lost block is recomputed from the lineage.
    """
    folded = ratings.with_fold(_ratings(spark, sf_dir), SEED).persist()
    train = folded.where(F.col("fold") == ratings.TRAIN).drop("fold")
    test = folded.where(F.col("fold") == ratings.TEST).drop("fold")
    return folded, train, test


def rating_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.fold_summary(_ratings(spark, sf_dir), SEED)


def global_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = ratings.split(_ratings(spark, sf_dir), SEED)
    return ratings.global_mean(train)


def global_mean_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded, train, test = _folds(spark, sf_dir)
    return releasing(ratings.global_mean_rmse(train, test, digits=6), folded)


def means_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded, train, _ = _folds(spark, sf_dir)
    return releasing(ratings.means_and_interaction(train, digits=6), folded)


def first_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded, train, _ = _folds(spark, sf_dir)
    return releasing(ratings.means_and_interaction(train, digits=6, n=FIRST), folded)


def als_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded, train, test = _folds(spark, sf_dir)
    return releasing(ratings.als_rmse(train, test, SEED), folded)


def als_bias_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded, train, test = _folds(spark, sf_dir)
    return releasing(ratings.als_bias_rmse(train, test, SEED), folded)


# FP-Growth thresholds (support, confidence) per basket fixture.
TYPE_THRESHOLDS = (0.05, 0.3)
BRAND_THRESHOLDS = (0.005, 0.1)
ITEM_SEP = ","
#: Rows of the queries that return the first rows of a report.
FIRST = 10


def _joined(col: str):
    return F.array_join(col, ITEM_SEP).alias(col)


def basket_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = baskets.basket_table(fixtures.basket_lines(spark, sf_dir, "p_type"), key="key")
    return b.select("id", "name", _joined("items"))


def first_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = baskets.basket_table(fixtures.basket_lines(spark, sf_dir, "p_type"), key="key", n=FIRST)
    return b.select("id", "name", _joined("items"))


def _model(spark: SparkSession, sf_dir: str, item_col: str, thresholds):
    # The baskets feed the fit and the basket count: build them once.
    b = fixtures.order_baskets(spark, sf_dir, item_col).persist()
    return b, baskets.fit(b, *thresholds)


def _itemsets(spark: SparkSession, sf_dir: str, item_col: str, thresholds,
              n: int | None = None) -> DataFrame:
    b, model = _model(spark, sf_dir, item_col, thresholds)
    return releasing(baskets.frequent_itemsets(model, n).select(_joined("items"), "size", "freq"), b)


def _rules(spark: SparkSession, sf_dir: str, n: int | None = None) -> DataFrame:
    b, model = _model(spark, sf_dir, "p_type", TYPE_THRESHOLDS)
    return releasing(baskets.association_rules(model, n).select(
        _joined("antecedent"), _joined("consequent"),
        F.round("confidence", 6).alias("confidence")), b)


def _interest(spark: SparkSession, sf_dir: str, n: int | None = None) -> DataFrame:
    b, model = _model(spark, sf_dir, "p_type", TYPE_THRESHOLDS)
    return releasing(baskets.rule_interest(model, b, n).select(
        _joined("antecedent"), _joined("consequent"),
        F.round("confidence", 6).alias("confidence"), _joined("items"), "freq",
        F.round("interest", 6).alias("interest")), b)


def frequent_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _itemsets(spark, sf_dir, "p_type", TYPE_THRESHOLDS)


def first_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _itemsets(spark, sf_dir, "p_type", TYPE_THRESHOLDS, FIRST)


def association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(spark, sf_dir)


def first_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(spark, sf_dir, FIRST)


def rule_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _interest(spark, sf_dir)


def first_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _interest(spark, sf_dir, FIRST)


def frequent_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _itemsets(spark, sf_dir, "p_brand", BRAND_THRESHOLDS)


K = 4  # clusters in the k-means queries


def membership_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The cells feed the domain size and the per-entity counts.
    cells = fixtures.nation_parts(spark, sf_dir).persist()
    return releasing(membership.membership_sets(cells), cells)


def membership_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership.lookups(fixtures.nation_parts(spark, sf_dir),
                              fixtures.nation_probes(spark, sf_dir))


def pair_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership.pair_distances(fixtures.nation_parts(spark, sf_dir),
                                     fixtures.neighbour_nations(spark, sf_dir))


#: Features in which near sets differ at most, in the queries.
RADIUS = 1


def near_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_sets.near_counts(near_sets.within_distance(fixtures.order_parts(spark, sf_dir), RADIUS))


def near_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_sets.within_distance(fixtures.order_parts(spark, sf_dir), RADIUS).pairs


def seeded_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.init_centroids(fixtures.customer_brands(spark, sf_dir), K, SEED)


def listed_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.init_centroids(fixtures.customer_brands(spark, sf_dir), K, SEED,
                                   fixtures.building_customers(spark, sf_dir))


def nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The cells feed the centroid choice and both layouts.
    cells = fixtures.customer_brands(spark, sf_dir).persist()
    return releasing(clusters.first_assignment(cells, K, SEED), cells)


def nearest_listed_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = fixtures.customer_brands(spark, sf_dir).persist()
    return releasing(clusters.first_assignment(
        cells, K, SEED, fixtures.building_customers(spark, sf_dir)), cells)


def kmeans_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = fixtures.customer_brands(spark, sf_dir).persist()
    result = clusters.kmeans(cells, K, SEED)
    cells.unpersist()
    return clusters.members(result.assignment, result.centroids)


#: Seconds without an event that end a session.
SESSION_GAP = 6 * 3600


def event_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.user_events(spark, sf_dir)
    views = events.where("event_type = 'view'").select(
        "user_id", "ts", F.col("event_id").alias("view_id"), F.col("cents").alias("view_cents"))
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    found = ordered.asof_join(bought, views, ["user_id"], "ts", "ts", ["view_id", "view_cents"])
    return found.select("event_id", "user_id", "view_id", "view_cents")


def _event_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.layout(fixtures.user_events(spark, sf_dir), ["user_id"], ["ts", "event_id"])


def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = ordered.over(_event_layout(spark, sf_dir), ["user_id"], numbered="nth", sums={"total": "cents"},
                        before={"last_type": "event_type"}, after={"next_id": "event_id"})
    return told.select("event_id", "user_id", F.col("nth").cast("bigint").alias("nth"), "total", "last_type", "next_id")


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = ordered.sessions(_event_layout(spark, sf_dir), ["user_id"], "ts", SESSION_GAP)
    return told.groupBy("user_id", "session").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.sum("cents").alias("cents"))


def order_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders", "o_orderstatus", "o_orderpriority", "o_custkey")
    by = ["o_orderstatus", "o_orderpriority"]
    return counts.grouping_sets(orders, [by, by[:1], by[1:], []], [
        F.count(F.lit(1)).alias("n"), F.max("o_custkey").alias("last_customer")])


#: How far sketches may be off: distinct counts by a share, ranks of quantiles by a share
#: of the rows (about three standard errors).
DISTINCT_OFF, RANK_OFF = 0.05, 0.03


def order_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and the median price by priority, from sketches of every month, and
    whether both are within their bounds of the exact figures."""
    orders = read_table(spark, sf_dir, "orders", "o_orderpriority", "o_orderdate", "o_custkey", "o_totalprice")
    by = ["o_orderpriority"]
    months = sketches.sketches(orders.withColumn("month", F.date_trunc("month", "o_orderdate")),
                               [*by, "month"], "o_custkey", "o_totalprice")
    told = sketches.estimates(sketches.merged(months, by), by, [0.5])
    joined = orders.join(told, by)
    median = F.col("quantiles")[0]
    return joined.groupBy(*by).agg(
        F.count_distinct("o_custkey").alias("n_customers"), F.first("n_distinct").alias("n"),
        F.count_if(F.col("o_totalprice").cast("double") <= median).alias("below"), F.count(F.lit(1)).alias("rows"),
    ).select(*by, "n_customers",
             (F.abs(F.col("n") / F.col("n_customers") - 1) <= DISTINCT_OFF).alias("distinct_close"),
             (F.abs(F.col("below") / F.col("rows") - 0.5) <= RANK_OFF).alias("median_close"))


QUERIES: dict[str, Query] = {
    "row_count": row_count,
    "present_count": present_count,
    "distinct_values": distinct_values,
    "value_counts": value_counts,
    "top_values": top_values,
    "common_values": common_values,
    "csv_lines": csv_line_rendering,
    "parse_ratings": parse_rating_lines,
    "csv_scan": csv_scan,
    "csv_account": csv_account,
    "csv_quoted_records": csv_quoted_records,
    "file_baskets": file_baskets,
    "rating_split": rating_split,
    "global_mean": global_mean,
    "global_mean_rmse": global_mean_rmse,
    "means_interaction": means_interaction,
    "first_means": first_means,
    "als_rmse": als_rmse,
    "als_bias_rmse": als_bias_rmse,
    "baskets": basket_ids,
    "first_baskets": first_baskets,
    "frequent_itemsets": frequent_itemsets,
    "first_itemsets": first_itemsets,
    "association_rules": association_rules,
    "first_rules": first_rules,
    "rule_interest": rule_interest,
    "first_interest": first_interest,
    "frequent_pairs": frequent_pairs,
    "membership_sets": membership_sets,
    "membership_lookup": membership_lookup,
    "pair_distances": pair_distances,
    "near_entities": near_entities,
    "near_pairs": near_pairs,
    "seeded_centroids": seeded_centroids,
    "listed_centroids": listed_centroids,
    "nearest_centroid": nearest_centroid,
    "nearest_listed_centroid": nearest_listed_centroid,
    "kmeans_converged": kmeans_converged,
    "event_asof": event_asof,
    "event_windows": event_windows,
    "event_sessions": event_sessions,
    "order_rollup": order_rollup,
    "order_sketches": order_sketches,
}
