"""CSV records with quoted line breaks, read by all tasks, and the account of
malformed ones.

A line break inside quotes does not end a record, and whether a line starts inside
quotes depends on everything before it.  So every line is read as a step between the
two states (outside and inside quotes); each split of a file works out its lines for
both states it may start in; one row per split then tells which it was.  Lines that
are whole records stay where they are; only those of longer records are grouped.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larch.operators.rowid import block_columns, position
from larch.session import stored

_STEPS = T.StructType([T.StructField("start0", T.LongType()), T.StructField("start1", T.LongType()),
                       T.StructField("after0", T.BooleanType()), T.StructField("after1", T.BooleanType())])
_SPLITS = ("_file string, _block bigint, _inside boolean, _before bigint, _open bigint, _crlf boolean")


def _char(c: str) -> str:
    if len(c) != 1:
        raise ValueError("separator and quote are single characters")
    return f"\\x{{{ord(c):x}}}"


def _ends_inside(line: Column, sep: str, quote: str) -> tuple[Column, Column]:
    """Whether the line ends inside quotes, having started outside or inside.

    Quotes count where a field starts; doubled ones within quotes are text, and
    what follows the closing quote is text up to the separator.
    """
    s, q = _char(sep), _char(quote)
    text = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+"
    fields = f"(?:(?:[^{q}{s}][^{s}]*+|{q}{text}{q}[^{s}]*+)?+{s})*+"
    outside = line.rlike(f"\\A{fields}{q}{text}\\z")
    inside = line.rlike(f"\\A{text}(?:{q}[^{s}]*+{s}{fields}{q}{text})?+\\z")
    quoted = F.contains(line, F.lit(quote))
    return quoted & outside, ~quoted | inside


class _Walk:
    """Lines of one split so far, for one state that it may have started in."""

    def __init__(self, inside: bool):
        self.inside, self.start = inside, -1

    def lines(self, first: int, from_outside: np.ndarray, from_inside: np.ndarray):
        """``(first line of each line's record, state after each line)``; a record
        that started in an earlier split has line -1."""
        n = len(from_outside)
        fixed, swap = from_outside == from_inside, from_outside & ~from_inside
        swaps = np.append(0, np.cumsum(swap))
        # The last line before that sets the state, whatever it was.
        last = np.append(-1, np.maximum.accumulate(np.where(fixed, np.arange(n), -1)))
        since = swaps - np.where(last < 0, 0, swaps[last + 1])
        base = np.where(last < 0, self.inside, from_outside[last])
        state = base ^ (since % 2 == 1)
        start = np.maximum.accumulate(np.append(
            self.start, np.where(state[:-1], -1, first + np.arange(n))))[1:]
        self.inside, self.start = bool(state[-1]), int(start[-1]) if n else self.start
        return start, state[1:]


@F.arrow_udf(_STEPS)
def _steps(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    split, walks, at = None, (), 0
    for file, block, outside, inside in batches:
        file, block, outside, inside = (
            x.to_numpy(zero_copy_only=False) for x in (file, block, outside, inside))
        n = len(file)
        cuts = [0, *(1 + np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1]))), n]
        found = ([], [], [], [])
        for low, high in zip(cuts[:-1], cuts[1:]):
            if low == high:
                continue
            if split != (file[low], block[low]):
                split, walks, at = (file[low], block[low]), (_Walk(False), _Walk(True)), 0
            for k, walk in enumerate(walks):
                start, after = walk.lines(at, outside[low:high], inside[low:high])
                found[k].append(start)
                found[2 + k].append(after)
            at += high - low
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64 if k < 2 else bool)
                   for k, c in enumerate(found)]
        yield pa.StructArray.from_arrays([pa.array(c) for c in columns],
                                         ["start0", "start1", "after0", "after1"])


def _resolved(splits) -> list[tuple]:
    """Every split's first state, lines before it in its file, and the first line of
    the record that is open there, from ``(file, block, lines, ...)`` in order."""
    rows, file = [], None
    for s in splits:
        if s["_file"] != file:
            file, inside, before, open_line, crlf = s["_file"], False, 0, -1, bool(s["crlf"])
        rows.append((file, s["_block"], inside, before, open_line, crlf))
        start, after = (s["end"]["start1"], s["end"]["after1"]) if inside else (
            s["end"]["start0"], s["end"]["after0"])
        if start >= 0:
            open_line = before + start
        inside, before = after, before + s["lines"]
    return rows


def csv_records(spark: SparkSession, path: str, sep: str = ",", quote: str = '"',
                encoding: str = "UTF-8") -> DataFrame:
    """``(file, line, record)``: every record of the CSV files at ``path``, a file or
    a folder, with the number of its first line in the file, from 0.

    Quoting follows RFC 4180.  Lines end with ``\\n``, or with ``\\r\\n`` throughout a
    file whose first line does; the breaks within a record come back as ``\\n``.  Empty
    lines are no records; an open quote at a file's end closes there.  ``encoding`` is
    UTF-8 or a charset of single bytes that extends ASCII.

    Every task reads its splits of the files, whatever their size; the lines are
    stored once with their place, and the driver sees one row per split.
    """
    if encoding.upper().replace("_", "-").startswith(("UTF-16", "UTF-32")):
        raise ValueError("line breaks are found in UTF-8 and single-byte charsets only")
    lines = spark.read.text(path, lineSep="\n")
    value = F.col("value")
    if encoding.upper() not in ("UTF-8", "UTF8"):
        value = F.decode(value.cast("binary"), encoding)
    told = lines.select(value.alias("value"), *block_columns(lines), position().alias("_at"))
    outside, inside = _ends_inside(F.col("value"), sep, quote)
    table, _ = stored(told.select(
        "*", _steps(F.xxhash64("_file"), F.col("_block"), outside, inside).alias("_step")))
    # The place within the split: a task's splits follow one another.
    splits = table.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("lines"), F.min("_at").alias("first"),
        F.max_by("_step", "_at").alias("end"),
        F.min_by(F.col("value").endswith("\r"), "_at").alias("crlf")).orderBy("_file", "_block").collect()
    starts = spark.createDataFrame(
        [(*row, s["first"]) for row, s in zip(_resolved(splits), splits)], _SPLITS + ", _first bigint")
    step = F.col("_step")
    start = F.when(F.col("_inside"), step["start1"]).otherwise(step["start0"])
    after = F.when(F.col("_inside"), step["after1"]).otherwise(step["after0"])
    number = F.col("_before") + F.col("_at") - F.col("_first")
    # One row per split, as the driver has them: the lines stay where they are.
    placed = table.join(F.broadcast(starts), ["_file", "_block"]).select(
        "_file", number.alias("_line"),
        F.when(start >= 0, F.col("_before") + start).otherwise(F.col("_open")).alias("_record"),
        F.when(F.col("_crlf"), F.regexp_replace("value", "\\r\\z", "")).otherwise(F.col("value")).alias("value"),
        after.alias("_open_after"))
    alone = (F.col("_record") == F.col("_line")) & ~F.col("_open_after")
    whole = placed.where(alone).select("_file", "_line", "value")
    parts = placed.where(~alone).groupBy("_file", F.col("_record").alias("_line")).agg(
        F.array_sort(F.collect_list(F.struct("_line", "value"))).alias("_parts"))
    joined = parts.select("_file", "_line", F.array_join(
        F.transform("_parts", lambda p: p["value"]), "\n").alias("value"))
    record = F.when(F.col("_line") == 0, F.regexp_replace("value", "\\A\ufeff", "")).otherwise(F.col("value"))
    return whole.unionAll(joined).select(
        F.col("_file").alias("file"), F.col("_line").alias("line"), record.alias("record")
    ).where(F.col("record") != "")


#: Column of the raw text of a malformed record, and the record's place.
MALFORMED, FILE, LINE = "_malformed", "_file", "_line"


def read_csv_records(spark: SparkSession, path: str, schema: T.StructType | None = None,
                     sep: str = ",", quote: str = '"', encoding: str = "UTF-8") -> DataFrame:
    """Headered CSV with quoted line breaks: every record with its fields, its file
    and line (from 1), and in ``_malformed`` its text where it has too few or too many
    fields or a field that is not of its type, else null.

    The first record of each file is its header.  Without a schema all fields are
    strings, named by the header of the first file.  :func:`kept`, :func:`dropped` and
    :func:`account` tell the records apart.
    """
    records = csv_records(spark, path, sep, quote, encoding)
    options = {"sep": sep, "quote": quote, "escape": quote, "mode": "PERMISSIVE",
               "columnNameOfCorruptRecord": MALFORMED}
    if schema is None:
        first = records.where("line = 0").orderBy("file").limit(1).select("record").first()
        names = next(csv.reader(io.StringIO(first[0]), delimiter=sep, quotechar=quote)) if first else []
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    taken = {MALFORMED, FILE, LINE} & set(schema.fieldNames())
    if taken:
        raise ValueError(f"columns {sorted(taken)} have the names of the account")
    told = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    return records.where("line > 0").select(
        F.from_csv("record", told.toDDL(), options).alias("_fields"),
        F.col("file").alias(FILE), (F.col("line") + 1).alias(LINE)).select("_fields.*", FILE, LINE)


def kept(records: DataFrame) -> DataFrame:
    """The fields of the well-formed records, as ``DROPMALFORMED`` would read them."""
    return records.where(F.col(MALFORMED).isNull()).drop(MALFORMED, FILE, LINE)


def dropped(records: DataFrame) -> DataFrame:
    """``(file, line, record)`` of the malformed records."""
    return records.where(F.col(MALFORMED).isNotNull()).select(
        F.col(FILE).alias("file"), F.col(LINE).alias("line"), F.col(MALFORMED).alias("record"))


def account(records: DataFrame) -> DataFrame:
    """One row ``(n_records, n_kept, n_dropped)`` from one scan."""
    bad = F.col(MALFORMED).isNotNull()
    return records.agg(F.count(F.lit(1)).alias("n_records"), F.count_if(~bad).alias("n_kept"),
                       F.count_if(bad).alias("n_dropped"))
