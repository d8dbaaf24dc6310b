"""Windows and as-of joins over an ordered layout, in which a hot key fills many
partitions.

A window by key moves all rows of a key into one task.  Here rows are range-partitioned
by key, order and row, so that a key with a third of all rows is cut into
many parts of bounded size.  Each part works out its own rows, one row per part and
key says what the part ends with, and these rows carry it to the key's later parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larch.operators.rowid import position
from larch.session import stored, tasks_for

ROWS_PER_PART = 2_000_000


def layout(df: DataFrame, keys: Sequence[str], order: Sequence[str],
           rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """``df`` by key and order, nulls first, with ``_part`` and ``_pos``, the place in
    the part; stored.  Rows equal in both come in the order of their hash.  Parts hold
    fewer than twice ``rows_per_part`` rows: their counts are checked and the range is
    cut finer while one is larger, so equal rows too are spread over parts."""
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields
              if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    by = [*keys, *order, "_hash", "_place"]
    told = df.withColumn("_hash", F.xxhash64(*hashed)).withColumn("_place", F.monotonically_increasing_id())
    parts = tasks_for(df.count(), rows_per_part)
    while True:
        table, drop = stored(
            told.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_hash", "_place")
            .withColumn("_part", F.spark_partition_id()).withColumn("_pos", position()))
        largest = table.groupBy("_part").count().agg(F.max("count")).first()[0] or 0
        if largest < 2 * max(2, rows_per_part):
            return table
        drop()
        parts *= 2


def over(laid: DataFrame, keys: Sequence[str], numbered: str | None = None,
         sums: dict[str, str] | None = None, before: dict[str, str] | None = None,
         after: dict[str, str] | None = None, latest: dict[str, str] | None = None) -> DataFrame:
    """Window columns by key over a :func:`layout`, in its order.

    ``numbered`` names the row number, from 1.  The others map new names to columns:
    the running sum up to the row, the value one row before and one row after
    (null at the key's ends), and the latest value that is not null up to the row.
    Null keys are one key.
    """
    sums, before, after, latest = sums or {}, before or {}, after or {}, latest or {}
    group = Window.partitionBy("_part", *keys)
    ordered = group.orderBy("_pos")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    own = laid.withColumns({
        "_first": F.min("_pos").over(group), "_n": F.row_number().over(ordered),
        **{f"_s{i}": F.sum(c).over(so_far) for i, c in enumerate(sums.values())},
        **{f"_b{i}": F.lag(F.struct(c)).over(ordered) for i, c in enumerate(before.values())},
        **{f"_a{i}": F.lead(F.struct(c)).over(ordered) for i, c in enumerate(after.values())},
        **{f"_l{i}": F.last(c, ignorenulls=True).over(so_far) for i, c in enumerate(latest.values())}})

    def at_end(c: str) -> Column:
        return F.max_by(F.struct(c), "_pos")

    parts = laid.groupBy("_part", *keys).agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"_s{i}") for i, c in enumerate(sums.values())],
        *[at_end(c).alias(f"_b{i}") for i, c in enumerate(before.values())],
        *[F.min_by(F.struct(c), "_pos").alias(f"_a{i}") for i, c in enumerate(after.values())],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_pos"))).alias(f"_l{i}")
          for i, c in enumerate(latest.values())])
    # One row per part and key: a key has as many as it fills parts.
    by_part = Window.partitionBy(*keys).orderBy("_part")
    earlier = by_part.rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(
        "_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_cn"),
        *[F.sum(f"_s{i}").over(earlier).alias(f"_cs{i}") for i in range(len(sums))],
        *[F.lag(f"_b{i}").over(by_part).alias(f"_cb{i}") for i in range(len(before))],
        *[F.lead(f"_a{i}").over(by_part).alias(f"_ca{i}") for i in range(len(after))],
        *[F.last(f"_l{i}", ignorenulls=True).over(earlier).alias(f"_cl{i}") for i in range(len(latest))])

    def added(i: int) -> Column:
        own_sum, past = F.col(f"_s{i}"), F.col(f"_cs{i}")
        return F.coalesce(own_sum + past, own_sum, past)

    joined = own.join(carried, ["_part", "_first"])
    new = [(F.col("_n") + F.col("_cn")).alias(numbered)] if numbered else []
    new += [added(i).alias(name) for i, name in enumerate(sums)]
    new += [F.coalesce(f"_b{i}", f"_cb{i}")[c].alias(name) for i, (name, c) in enumerate(before.items())]
    new += [F.coalesce(f"_a{i}", f"_ca{i}")[c].alias(name) for i, (name, c) in enumerate(after.items())]
    new += [F.coalesce(f"_l{i}", f"_cl{i}").alias(name) for i, name in enumerate(latest)]
    names = {numbered, *sums, *before, *after, *latest}
    return joined.select(*[c for c in laid.columns if c not in names], *new)


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
              values: Sequence[str], rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Every row of ``left`` with the ``values`` of the last row of ``right`` of the
    same key whose time is not later; nulls where there is none.

    Both tables become one in order of key and time, through which the last right row
    is carried: no pairs of rows are formed, and a hot key is cut into parts.  Of
    right rows of one time the one with the greatest values counts.  Null times and
    null keys match nothing; left rows with them stay.  The names of ``values`` must not
    be columns of ``left``.
    """
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are in both tables")
    fine = F.col(left_time).isNotNull()
    for k in keys:
        fine = fine & F.col(k).isNotNull()
    there = F.col(right_time).isNotNull()
    for k in keys:
        there = there & F.col(k).isNotNull()
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    rows = left.where(fine).select(
        *named, F.col(left_time).alias("_time"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"))
    told = right.where(there).select(
        *named, F.col(right_time).alias("_time"), F.lit(0).alias("_side"), F.struct(*values).alias("_value"))
    both = rows.unionByName(told, allowMissingColumns=True)
    ids = [f"_k{i}" for i in range(len(keys))]
    laid = layout(both, ids, ["_time", "_side", "_value"], rows_per_part)
    found = over(laid, ids, latest={"_found": "_value"}).where("_side = 1")
    types = {f.name: f.dataType for f in right.schema.fields}
    # A value that is null all the same came from a right row.
    result = found.select("_row.*", *[F.col("_found")[v].alias(v) for v in values])
    return result.unionByName(left.where(~F.coalesce(fine, F.lit(False))).select(
        "*", *[F.lit(None).cast(types[v]).alias(v) for v in values]))


def sessions(laid: DataFrame, keys: Sequence[str], time: str, gap_seconds: int) -> DataFrame:
    """A layout in order of ``time`` with ``session``, from 1 within the key: a row more
    than ``gap_seconds`` after the one before starts a new one."""
    told = over(laid, keys, before={"_last": time})
    late = F.col("_last").isNull() | (
        F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.col("_last").cast("timestamp"))
        > gap_seconds * 1_000_000)
    return over(told.withColumn("_new", late.cast("bigint")), keys, sums={"session": "_new"}).drop("_last", "_new")
