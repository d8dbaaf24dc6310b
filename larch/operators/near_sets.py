"""Entities whose feature sets differ in at most ``radius`` features.

The distance is that of :func:`larch.operators.membership.pair_distances`: the
features that exactly one of the two holds.  Equal sets form a class, and only one
member of each class is compared.  Two sets within the radius share one of their
rarest features (prefix filter) and have like sizes (size filter), so candidates meet
on the pair of a rare feature and a size.  Those whose parity marks differ in more bits
than the radius are out (mark filter); what the others differ in is counted exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larch.operators.membership import pair_distances
from larch.session import stored


@dataclass
class NearSets:
    classes: DataFrame      # (entity, class): the smallest entity with the same set
    pairs: DataFrame        # (a, b, distance): a < b, the smallest members of two classes


#: Bits of the parity mark of a set.
MARK_BITS = 64


def _marks(cells: DataFrame) -> DataFrame:
    """``(entity, n, x, p)``: size, hash and parity mark of every set.  A feature flips
    one bit of the mark, so two marks differ in no more bits than their sets in features.
    """
    h = F.xxhash64("feature")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"),
                          F.pmod(F.xxhash64("feature", F.lit(1)), F.lit(MARK_BITS)).cast("int"))
    return cells.groupBy("entity").agg(
        F.count(F.lit(1)).cast("int").alias("n"), F.bit_xor(h).alias("x"), F.bit_xor(bit).alias("p"))


def _classes(cells: DataFrame, marks: DataFrame) -> DataFrame:
    same = ["n", "x", "p"]
    # Sets without an equal need not meet again.
    least, drop = stored(marks.groupBy(*same).agg(F.min("entity").alias("class"), F.count(F.lit(1)).alias("_k"))
                         .where("_k > 1").drop("_k"))
    guess, _ = stored(marks.join(least, same, "left").select(
        "entity", F.coalesce("class", "entity").alias("class")))
    drop()
    members = guess.where(F.col("entity") != F.col("class"))
    differ = (pair_distances(cells, members.select(F.col("entity").alias("a"), F.col("class").alias("b")))
              .where("distance > 0").select(F.col("a").alias("entity"), F.lit(True).alias("_alone")))
    return guess.join(differ, "entity", "left").select(
        "entity", F.when(F.col("_alone"), F.col("entity")).otherwise(F.col("class")).alias("class"))


def set_classes(cells: DataFrame) -> DataFrame:
    """``(entity, class)``: every entity with the smallest entity that holds the same
    features.  Sets meet by size, hash and mark; a member that differs from its
    class all the same stands alone."""
    return _classes(cells, _marks(cells))


def _prefixes(cells: DataFrame, radius: int, marks: DataFrame | None = None) -> DataFrame:
    """``(entity, size, mark, feature, at)``: the first ``radius + 1`` features of each
    set, rarest first, with the set's size and mark."""
    held = cells.groupBy("feature").agg(F.count(F.lit(1)).alias("_held"))
    order = Window.partitionBy("entity").orderBy("_held", "feature")
    # The rank limit reaches the tasks before the shuffle: a large set moves little.
    first = (cells.join(held, "feature").withColumn("_n", F.row_number().over(order))
             .where(F.col("_n") <= radius + 1)
             .select("entity", "feature", (F.col("_n") - 1).alias("at")))
    sizes = (_marks(cells) if marks is None else marks).select(
        "entity", F.col("n").alias("size"), F.col("p").alias("mark"))
    return first.join(sizes, "entity").select("entity", "size", "mark", "feature", "at")


def _candidates(prefixes: DataFrame, radius: int) -> DataFrame:
    """Pairs ``(a, b)`` that can be within the radius, each once.  Pairs whose marks
    differ in more bits are dropped where they meet."""
    small = prefixes.select(F.col("entity").alias("a"), F.col("size").alias("_size"), "feature",
                            F.col("at").alias("_at"), F.col("mark").alias("_p")
                            ).where(F.col("at") <= radius // 2)
    # The larger set meets every size that the smaller may have.
    large = prefixes.select(
        F.col("entity").alias("b"), F.col("size").alias("_large"), "feature", F.col("at").alias("_from"),
        F.col("mark").alias("_q"),
        F.explode(F.sequence(F.greatest(F.lit(1), F.col("size") - radius), F.col("size"))).alias("_size")
    ).where(F.col("_from") <= F.floor((radius + F.col("_large") - F.col("_size")) / 2))
    once = (F.col("_size") < F.col("_large")) | (F.col("a") < F.col("b"))
    like = F.bit_count(F.col("_p").bitwiseXOR(F.col("_q"))) <= radius
    sharing = (small.join(large, ["feature", "_size"])
               .where(once & like & (F.col("_at") <= F.floor((radius - F.col("_large") + F.col("_size")) / 2)))
               .select("a", "b"))
    # Sets so small that they need not share anything: all of these are within.
    sizes = prefixes.where("at = 0").select("entity", "size").where(F.col("size") < radius)
    tiny = sizes.where(F.col("size") <= radius // 2).select(
        F.col("entity").alias("a"), F.col("size").alias("_small"),
        F.explode(F.sequence(F.col("size"), radius - F.col("size"))).alias("size"))
    free = (tiny.join(sizes.withColumnRenamed("entity", "b"), "size")
            .where((F.col("_small") < F.col("size")) | (F.col("a") < F.col("b"))).select("a", "b"))
    found = sharing.unionAll(free) if radius > 1 else sharing
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def within_distance(cells: DataFrame, radius: int) -> NearSets:
    """All pairs of entities whose sets differ in at most ``radius`` features.

    ``cells`` are distinct ``(entity, feature)`` rows; rows without either are no
    cells, and an entity without cells is in no pair.  Pairs come between the smallest
    members of two classes of equal sets; every other pair follows from the classes
    (members of one class have distance 0).  ``radius`` 0 gives the classes alone.
    """
    if radius < 0:
        raise ValueError("the radius is not negative")
    cells = cells.select("entity", "feature").where(
        F.col("entity").isNotNull() & F.col("feature").isNotNull())
    # Read by every step: one copy, and of the marks too, each gone at the end.
    cells, drop_cells = stored(cells)
    marks, drop_marks = stored(_marks(cells))
    classes, _ = stored(_classes(cells, marks))
    copies = classes.where(F.col("entity") != F.col("class")).select("entity")
    reps, drop_reps = stored(cells.join(copies, "entity", "left_anti"))
    prefixes, drop_prefixes = stored(_prefixes(reps, radius, marks))
    candidates, drop_candidates = stored(_candidates(prefixes, radius))
    pairs, _ = stored(pair_distances(reps, candidates).where(F.col("distance") <= radius))
    for drop in (drop_cells, drop_marks, drop_reps, drop_prefixes, drop_candidates):
        drop()
    return NearSets(classes, pairs)


def near_counts(near: NearSets) -> DataFrame:
    """``(entity, class, n_near)``: the other entities within the radius of each one."""
    sizes = near.classes.groupBy("class").agg(F.count(F.lit(1)).alias("_members"))
    ends = near.pairs.select(F.col("a").alias("class"), F.col("b").alias("_other")).unionAll(
        near.pairs.select(F.col("b").alias("class"), F.col("a").alias("_other")))
    others = (ends.join(sizes.withColumnRenamed("class", "_other").withColumnRenamed("_members", "_n"), "_other")
              .groupBy("class").agg(F.sum("_n").alias("_n")))
    totals = sizes.join(others, "class", "left").select(
        "class", (F.col("_members") - 1 + F.coalesce("_n", F.lit(0))).alias("n_near"))
    return near.classes.join(totals, "class").select("entity", "class", "n_near")
