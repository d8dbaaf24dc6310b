"""CSV rendering as a column, and the CSV file sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def csv_field(col: Column | str, sep: str = ",") -> Column:
    """One CSV field (RFC 4180): quoted only when it holds the separator, a
    quote or a line break, inner quotes doubled; NULL renders as an empty field."""
    c = F.col(col) if isinstance(col, str) else col
    s = c.cast("string")
    needs_quotes = s.rlike('["\r\n]') | s.contains(sep)
    quoted = F.concat(F.lit('"'), F.regexp_replace(s, '"', '""'), F.lit('"'))
    return F.coalesce(F.when(needs_quotes, quoted).otherwise(s), F.lit(""))


def csv_lines(df: DataFrame, sep: str = ",", list_sep: str = " ",
              name: str = "line") -> DataFrame:
    """Render every row as one CSV line.  Arrays are joined with
    ``list_sep`` into one field.  Row order is the order of ``df``."""
    fields = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, list_sep)
        fields.append(csv_field(c, sep))
    return df.select(F.concat_ws(sep, *fields).alias(name))


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """Write with Spark's CSV writer, one file per partition."""
    df.write.mode(mode).option("header", header).csv(path)
