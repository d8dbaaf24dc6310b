"""Sources and sinks: Parquet driver tables, headered CSV, text lines,
delimited and ragged records, and CSV rendering."""

from larch.sources.records import account, csv_records, dropped, kept, read_csv_records
from larch.sources.tables import TABLES, read_table, table_path
from larch.sources.text import (
    parse_delimited,
    parse_ragged,
    parse_ratings,
    read_csv_table,
    read_lines,
)
from larch.sources.sinks import csv_field, csv_lines, write_csv

__all__ = [
    "TABLES", "read_table", "table_path",
    "read_csv_table", "read_lines", "parse_delimited", "parse_ratings", "parse_ragged",
    "csv_records", "read_csv_records", "kept", "dropped", "account",
    "csv_field", "csv_lines", "write_csv",
]
