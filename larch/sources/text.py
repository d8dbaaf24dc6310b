"""Text inputs: headered CSV files, raw lines, delimited and ragged records.

Malformed input is dropped, never raised: CSV rows with the wrong number of
fields (``DROPMALFORMED``) and delimited lines whose fields do not cast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _quoted(sep: str) -> str:
    """A Java regex matching ``sep`` literally (``F.split`` takes a regex)."""
    return "\\Q" + sep + "\\E"


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """Headered CSV with every column read as a string.

    Rows with too few or too many fields are dropped.  CSV column pruning is
    switched off so that which rows are malformed does not depend on the
    columns a query happens to select: ``count()``, ``select(c).count()`` and
    ``collect()`` then agree.  Quoted line breaks need ``multi_line=True``
    (each file is then read by one task, so it is opt-in).
    """
    reader = (spark.read.option("header", True)
              .option("encoding", encoding)
              .option("multiLine", multi_line))
    if schema is None:
        # Header names only: all columns are strings, nothing is inferred.
        names = reader.csv(path).columns
        schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    return (reader.schema(schema)
            .option("mode", "DROPMALFORMED")
            .option("columnPruning", False)
            .csv(path))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def parse_delimited(lines: DataFrame, sep: str, fields: Sequence[tuple[int, str, str]],
                    value_col: str = "value") -> DataFrame:
    """Split each line on a literal separator and keep typed fields.

    ``fields`` lists ``(position, name, spark_type)``.  A line missing a field
    or holding a value that does not cast is dropped.
    """
    parts = F.split(F.col(value_col), _quoted(sep))
    # F.get: NULL past the end of a short line (getItem raises under ANSI).
    cols = [F.get(parts, pos).try_cast(typ).alias(name) for pos, name, typ in fields]
    names = [name for _, name, _ in fields]
    keep = F.lit(True)
    for name in names:
        keep = keep & F.col(name).isNotNull()
    return lines.select(*cols).where(keep)


RATING_FIELDS = ((0, "userId", "bigint"), (1, "itemId", "bigint"), (2, "rating", "double"))


def parse_ratings(lines: DataFrame, sep: str = "::", value_col: str = "value") -> DataFrame:
    """``user::item::rating::timestamp`` lines to ``(userId, itemId, rating)``.

    The timestamp field is not read.  Ids are BIGINT; ALS numbers them itself.
    """
    return parse_delimited(lines, sep, RATING_FIELDS, value_col)


def parse_ragged(lines: DataFrame, sep: str = ",", value_col: str = "value",
                 keep: Sequence[str | Column] = ()) -> DataFrame:
    """``name,item,item,...`` lines to ``(name, items)``.

    Items keep their order in the line; a line holding only a name gives an
    empty array.  ``keep`` carries other columns of ``lines`` through.
    """
    parts = F.split(F.col(value_col), _quoted(sep))
    return lines.select(
        *keep,
        parts.getItem(0).alias("name"),
        F.slice(parts, 2, F.size(parts) - 1).alias("items"),
    )
