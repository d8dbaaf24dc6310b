"""Operator inputs derived from the driver tables.

Each fixture is a lazy DataFrame over the Parquet scans, so its work grows
with the tables and Catalyst prunes columns and pushes filters into the
scans.  Joins are left to the optimizer: AQE turns a join into a broadcast
only when the runtime size of a side is under
``spark.sql.autoBroadcastJoinThreshold``, otherwise it stays sort-merge
(with skew splitting).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larch.session import new_folder, tasks_for
from larch.sources import csv_field, read_table


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(p_partkey, label)``; ``label`` is NULL for parts above size 25."""
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_size")
    return part.select(
        "p_partkey",
        F.when(F.col("p_size") <= 25, F.col("p_name")).alias("label"),
    )


def _year_filter(col: str, year: int):
    # A range on the raw column (not year(col)) so the filter reaches the
    # Parquet scan as PushedFilters.
    lo = F.lit(dt.datetime(year, 1, 1)).cast("timestamp_ntz")
    hi = F.lit(dt.datetime(year + 1, 1, 1)).cast("timestamp_ntz")
    return (F.col(col) >= lo) & (F.col(col) < hi)


def period_customers(spark: SparkSession, sf_dir: str, year: int) -> DataFrame:
    """``c_name`` of every customer with an order dated in ``year``.

    A semi join: a customer appears once however many orders it has.
    """
    orders = (read_table(spark, sf_dir, "orders", "o_custkey", "o_orderdate")
              .where(_year_filter("o_orderdate", year)))
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_name")
    return (customer.join(orders, customer.c_custkey == orders.o_custkey, "left_semi")
            .select("c_name"))


#: Lines of one task of a join or an aggregation.
LINES_PER_TASK = 2_000_000


def _spread(rows: DataFrame, lines: int, *keys: str, cores: bool = True) -> DataFrame:
    """``rows`` dealt by ``keys`` over as many tasks as ``lines`` need, where these are
    more than the session's shuffle partitions or, for ``cores``, its cores, which AQE
    merges partitions down to; else as they are."""
    spark, tasks = rows.sparkSession, tasks_for(lines, LINES_PER_TASK)
    enough = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if cores:
        enough = min(enough, spark.sparkContext.defaultParallelism)
    return rows.repartition(tasks, *keys) if tasks > enough else rows


def _branded_lines(spark: SparkSession, sf_dir: str, *columns: str) -> tuple[DataFrame, int]:
    """Lines with ``columns``, their customer and brand, and the number of all lines."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", *columns)
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_brand")
    n = li.count()
    ordered = _spread(li, n, "l_orderkey").join(
        _spread(orders, n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    # The parts may be broadcast: the lines are not moved for them without need.
    return _spread(ordered, n, "l_partkey", cores=False).join(
        _spread(part, n, "p_partkey", cores=False), F.col("l_partkey") == F.col("p_partkey")), n


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(userId, itemId, rating, n_lines)``: one rating per customer and
    brand, ``ceil(avg(quantity) / 10)``, so ratings are integers 1..5.

    Ids are BIGINT (customer keys outgrow INT at large scale); the ALS
    operators number them densely themselves."""
    joined, n = _branded_lines(spark, sf_dir, "l_quantity")
    rated = joined.select(F.col("o_custkey").alias("userId"),
                          F.expr("substring(p_brand, 7)").cast("bigint").alias("itemId"), "l_quantity")
    return (_spread(rated, n, "userId", "itemId").groupBy("userId", "itemId")
            .agg(F.ceil(F.avg("l_quantity") / 10).cast("double").alias("rating"),
                 F.count(F.lit(1)).alias("n_lines")))


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratings as ``user::item::rating::n`` text lines, column ``value``."""
    r = ratings(spark, sf_dir)
    return r.select(F.concat_ws(
        "::", F.col("userId").cast("string"), F.col("itemId").cast("string"),
        F.col("rating").cast("int").cast("string"), F.col("n_lines").cast("string"),
    ).alias("value"))


def order_baskets(spark: SparkSession, sf_dir: str, item_col: str = "p_type") -> DataFrame:
    """``(id, items)``: the distinct part attribute values of each order.

    ``collect_set`` deduplicates map-side, so a basket never holds more
    than the attribute's vocabulary, however many lines the order has.
    """
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey")
    part = read_table(spark, sf_dir, "part", "p_partkey", item_col)
    return (li.join(part, li.l_partkey == part.p_partkey)
            .groupBy(F.col("l_orderkey").alias("id"))
            .agg(F.array_sort(F.collect_set(item_col)).alias("items")))


def basket_lines(spark: SparkSession, sf_dir: str, item_col: str = "p_type") -> DataFrame:
    """Baskets rendered as ``name,item,item`` lines plus their order key."""
    b = order_baskets(spark, sf_dir, item_col)
    return b.select(
        F.col("id").alias("key"),
        F.concat_ws(",", F.col("id").cast("string"), F.array_join("items", ",")).alias("value"),
    )


def nation_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership ``(entity, feature)``: nation of the customer x part bought."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    return (li.join(orders, li.l_orderkey == orders.o_orderkey)
            .join(customer, orders.o_custkey == customer.c_custkey)
            .select(F.col("c_nationkey").alias("entity"), F.col("l_partkey").alias("feature"))
            .distinct())


def order_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership ``(entity, feature)``: order x part bought."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey")
    return li.select(F.col("l_orderkey").alias("entity"), F.col("l_partkey").alias("feature")).distinct()


def customer_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership ``(entity, feature)``: customer x brand bought."""
    joined, n = _branded_lines(spark, sf_dir)
    cells = joined.select(F.col("o_custkey").alias("entity"), F.col("p_brand").alias("feature"))
    return _spread(cells, n, "entity", "feature").distinct()


def building_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A given list of centroid candidates: customers of one market segment."""
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    return (customer.where(F.col("c_mktsegment") == "BUILDING")
            .select(F.col("c_custkey").alias("entity")))


def nation_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership probes ``(entity, feature)``: every part with the nation that
    its key names in turn, some of them with a nation that does not exist."""
    part = read_table(spark, sf_dir, "part", "p_partkey")
    return part.select((F.col("p_partkey") % 30).alias("entity"), F.col("p_partkey").alias("feature"))


def neighbour_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs ``(a, b)``: every nation with the next one by key."""
    nation = read_table(spark, sf_dir, "nation", "n_nationkey")
    return nation.select(F.col("n_nationkey").alias("a"), (F.col("n_nationkey") + 1).alias("b"))


def basket_files(spark: SparkSession, sf_dir: str, item_col: str = "p_type") -> str:
    """A folder of text files with the basket lines, in the order of their keys."""
    path = new_folder(spark, "lines")
    basket_lines(spark, sf_dir, item_col).orderBy("key").select("value").write.text(path)
    return path


#: Rows and bytes of fields of one CSV file, about.
FILE_ROWS = 500_000
FILE_BYTES = 64 * 2**20


def _csv_files(table: DataFrame, key: str, damage=None) -> str:
    """A folder of CSV files with headers that holds the rows of ``table``, each
    rendered as one record (``damage`` changes its text); returns the pattern of their
    paths.  The number of files follows the rows and their bytes; every file has a
    task of its own."""
    spark, names = table.sparkSession, table.columns
    path = new_folder(spark, "csv")
    length = sum((F.coalesce(F.octet_length(F.col(n).cast("string")), F.lit(0)) for n in names), F.lit(0))
    n, size = table.agg(F.count(F.lit(1)), F.sum(length.cast("bigint"))).first()
    files = max(tasks_for(n, FILE_ROWS), tasks_for(size or 0, FILE_BYTES))
    value = F.concat_ws(",", *[csv_field(n) for n in names])
    rows = table.select(F.pmod(F.xxhash64(key), F.lit(files)).cast("int").alias("file"), F.lit(1).alias("place"),
                        (damage(value) if damage else value).alias("value"))
    heads = spark.range(files).select(F.col("id").cast("int").alias("file"), F.lit(0).alias("place"),
                                      F.lit(",".join(names)).alias("value"))
    (heads.unionAll(rows).repartitionById(files, "file").sortWithinPartitions("file", "place")
     .select("file", "value").write.partitionBy("file").text(path))
    return f"{path}/*"


def part_files(spark: SparkSession, sf_dir: str) -> str:
    """CSV files of the parts.  Every tenth part has a field too many, every tenth
    from the fifth on a field too few."""
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_size")
    rest = F.col("p_partkey") % 10
    return _csv_files(part, "p_partkey", lambda line: F.when(rest == 0, F.concat(line, F.lit(",x")))
                      .when(rest == 5, F.regexp_replace(line, ",[^,]*$", "")).otherwise(line))


PART_FIELDS = T.StructType([
    T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
    T.StructField("p_brand", T.StringType()), T.StructField("p_size", T.IntegerType())])


def document_files(spark: SparkSession, sf_dir: str) -> str:
    """CSV files of the documents, whose texts have quotes and line breaks."""
    return _csv_files(read_table(spark, sf_dir, "documents", "doc_id", "lang", "text"), "doc_id")


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their value in cents; every third user is user 0, who so has a third
    of all rows."""
    events = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    return events.select(
        "event_id", "ts", F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).cast("bigint")
        .alias("user_id"), "event_type", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
