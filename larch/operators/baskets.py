"""Market baskets: the basket table, frequent itemsets (FP-Growth),
association rules with a single-item consequent, and rule interest
``|confidence - freq(consequent) / N|``.

Baskets are ``(id, name, items array<string>)``.  FP-Growth is MLlib's
parallel FP-Growth: it counts items with a shuffle, ranks the frequent
ones (bounded by the item vocabulary), and mines conditional trees per
item group in parallel.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larch.functions import items_string
from larch.operators.rowid import line_ids, ordered_ids
from larch.session import tasks_for
from larch.sources import parse_ragged


def basket_table(lines: DataFrame, key: str | None = None, n: int | None = None,
                 sep: str = ",") -> DataFrame:
    """``(id, name, items)`` from ``name,item,item`` lines, ordered by id.

    ``id`` is the line number - 1.  For a text file read with
    ``spark.read.text`` leave ``key`` unset: lines are numbered by file
    position.  For lines held in a table, ``key`` names the numeric column
    that gives the line order.  ``n`` keeps the first ``n`` baskets.
    """
    keep = [key] if key else []
    parsed = parse_ragged(lines, sep=sep, keep=keep)
    with_id = ordered_ids(parsed, key, tie_cols=("name", "items")) if key else line_ids(parsed)
    out = with_id.select("id", "name", "items").orderBy("id")
    return out.limit(n) if n is not None else out


#: Baskets that one task of the mining should hold.
BASKETS_PER_TASK = 250_000


def fit(baskets: DataFrame, min_support: float, min_confidence: float,
        items_col: str = "items") -> FPGrowthModel:
    """Fit FP-Growth.  NULL baskets are dropped (MLlib would not count them
    in N either); repeated items in a basket are removed first.

    The number of mining tasks follows the number of baskets, not the bytes
    of the input's partitions."""
    clean = (baskets.where(F.col(items_col).isNotNull())
             .select(F.array_distinct(items_col).alias("items")))
    tasks = max(8, tasks_for(clean.count(), BASKETS_PER_TASK))
    return FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence,
                    numPartitions=tasks).fit(clean)


def frequent_itemsets(model: FPGrowthModel, n: int | None = None) -> DataFrame:
    """``(items, size, freq)`` with items sorted, ordered by size desc, freq
    desc, then items."""
    out = model.freqItemsets.select(
        F.array_sort("items").alias("items"),
        F.size("items").alias("size"),
        F.col("freq"),
    ).orderBy(F.desc("size"), F.desc("freq"), items_string("items"))
    return out.limit(n) if n is not None else out


def association_rules(model: FPGrowthModel, n: int | None = None) -> DataFrame:
    """``(antecedent, consequent, confidence)``, ordered by antecedent size
    desc, confidence desc, then the rule's items."""
    out = model.associationRules.select(
        F.array_sort("antecedent").alias("antecedent"),
        F.col("consequent"),
        F.col("confidence"),
    ).orderBy(F.desc(F.size("antecedent")), F.desc("confidence"),
              items_string("antecedent"), items_string("consequent"))
    return out.limit(n) if n is not None else out


def rule_interest(model: FPGrowthModel, baskets: DataFrame, n: int | None = None,
                  items_col: str = "items") -> DataFrame:
    """Rules with the frequency of their consequent and
    ``interest = |confidence - freq(consequent) / N|``, N = non-NULL baskets.

    Consequents hold one item, so the join with the itemsets is an
    equi-join on that item against the frequent single items, a table
    bounded by the item vocabulary.
    """
    total = baskets.where(F.col(items_col).isNotNull()).select(F.count(F.lit(1))).scalar()
    singles = (model.freqItemsets.where(F.size("items") == 1)
               .select(F.col("items").getItem(0).alias("_item"), "items", "freq"))
    rules = model.associationRules.select(
        F.array_sort("antecedent").alias("antecedent"), "consequent", "confidence")
    out = (rules.join(singles, rules.consequent.getItem(0) == singles._item)
           .select("antecedent", "consequent", "confidence", "items", "freq",
                   F.abs(F.col("confidence") - F.col("freq") / total).alias("interest")))
    out = out.orderBy(F.desc(F.size("antecedent")), F.desc("interest"),
                      items_string("antecedent"), items_string("consequent"))
    return out.limit(n) if n is not None else out
