"""Sparse 0/1 membership of entities in features, and set distances.

The membership matrix is kept long: one row ``(entity, feature)`` per cell
holding 1.  Nothing is collected per entity, so an entity holding a third
of all cells is just a third of the rows, spread over tasks.

The distance between two 0/1 vectors is the number of features that exactly
one of them holds.  It is computed for stated pairs of entities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def membership(df: DataFrame, entity: str, feature: str) -> DataFrame:
    """Distinct ``(entity, feature)`` cells of a fact table."""
    return df.select(F.col(entity).alias("entity"), F.col(feature).alias("feature")).distinct()


def membership_from_baskets(baskets: DataFrame, name_col: str = "name",
                            items_col: str = "items") -> DataFrame:
    """Transpose baskets into membership: every item of a basket is an
    entity holding the basket's name as a feature (plants found in states
    give states holding plants)."""
    return (baskets.select(F.explode(items_col).alias("entity"), F.col(name_col).alias("feature"))
            .distinct())


def membership_sets(cells: DataFrame) -> DataFrame:
    """``(entity, n_features, n_absent)``; absent = features of the whole
    domain that the entity does not hold."""
    domain = cells.select(F.count_distinct("feature")).scalar()
    return (cells.groupBy("entity").agg(F.count(F.lit(1)).alias("n_features"))
            .select("entity", "n_features", (domain - F.col("n_features")).alias("n_absent")))


def lookup(cells: DataFrame, entity, feature) -> DataFrame:
    """One row: ``present`` is true iff the cell holds 1 (unknown keys: false)."""
    hit = cells.where((F.col("entity") == F.lit(entity)) & (F.col("feature") == F.lit(feature)))
    return hit.agg((F.count(F.lit(1)) > 0).alias("present"))


def pair_distance(cells: DataFrame, a, b) -> DataFrame:
    """Squared Euclidean distance of two entities' 0/1 vectors: the number
    of features held by exactly one of them.  One row, ``distance``."""
    two = cells.where(F.col("entity").isin(a, b)) if a != b else cells.limit(0)
    per_feature = two.groupBy("feature").agg(F.count(F.lit(1)).alias("_k"))
    return per_feature.agg(F.coalesce(F.sum(F.when(F.col("_k") == 1, 1).otherwise(0)),
                                      F.lit(0)).cast("bigint").alias("distance"))


def lookups(cells: DataFrame, probes: DataFrame) -> DataFrame:
    """``(entity, feature, present)`` for every stated probe
    ``(entity, feature)``; unknown keys are false."""
    held = cells.select("entity", "feature", F.lit(True).alias("_held")).distinct()
    return probes.join(held, ["entity", "feature"], "left").select(
        "entity", "feature", F.coalesce("_held", F.lit(False)).alias("present"))


def pair_distances(cells: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(a, b, distance)`` for every stated pair of entities: the squared
    Euclidean distance of their 0/1 vectors, the number of features that
    exactly one of them holds.

    Each pair brings in the cells of its two entities; one aggregation per
    (pair, feature) keeps the features held once.  An entity without cells is
    the zero vector; repeated pairs give one row.
    """
    wanted = pairs.select("a", "b").distinct()
    sides = wanted.where(F.col("a") != F.col("b")).select(
        "a", "b", F.explode(F.array("a", "b")).alias("entity"))
    once = (sides.join(cells, "entity").groupBy("a", "b", "feature")
            .agg(F.count(F.lit(1)).alias("_k")).where("_k = 1"))
    counted = once.groupBy("a", "b").agg(F.count(F.lit(1)).alias("_n"))
    return wanted.join(counted, ["a", "b"], "left").select(
        "a", "b", F.coalesce("_n", F.lit(0)).cast("bigint").alias("distance"))
