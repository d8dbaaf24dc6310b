"""Counting operators on hand-made rows: NULL, empty and blank labels, ties."""

from pyspark.sql import types as T

from larch.operators import counts

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()),
                       T.StructField("label", T.StringType())])
ROWS = [(1, "b"), (2, "a"), (3, None), (4, ""), (5, "  "), (6, "a"), (7, "b"),
        (8, "NA"), (9, "c"), (10, "Érable"), (11, "ab")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def test_row_and_present_count(spark):
    df = frame(spark)
    assert counts.row_count(df).first().n == 11
    # NULL and '' are absent; blank-only and 'NA' are values.
    assert counts.present_count(df, "label").first().n == 9


def test_distinct_values_code_point_order(spark):
    got = [r.label for r in counts.distinct_values(frame(spark), "label").collect()]
    assert got == ["  ", "NA", "a", "ab", "b", "c", "Érable"]


def test_value_counts(spark):
    got = [tuple(r) for r in counts.value_counts(frame(spark), "label").collect()]
    assert got == [("  ", 1), ("NA", 1), ("a", 2), ("ab", 1), ("b", 2), ("c", 1), ("Érable", 1)]


def test_top_values_ties_by_name(spark):
    got = [tuple(r) for r in counts.top_values(frame(spark), "label", k=4).collect()]
    assert got == [("a", 2), ("b", 2), ("  ", 1), ("NA", 1)]


def test_common_values(spark):
    left = frame(spark)
    right = frame(spark, [(1, "b"), (2, "z"), (3, None), (4, ""), (5, "b"), (6, "Érable")])
    got = [r.label for r in counts.common_values(left, right, "label").collect()]
    assert got == ["b", "Érable"]


def test_empty_input(spark):
    df = frame(spark, [])
    assert counts.row_count(df).first().n == 0
    assert counts.top_values(df, "label").count() == 0
    assert counts.value_counts(df, "label").count() == 0
