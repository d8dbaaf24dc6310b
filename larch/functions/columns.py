"""Column expressions.  Everything here compiles to Catalyst expressions, so
it stays inside whole-stage codegen; there is no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: Column | str) -> Column:
    """A value is present when it is neither NULL nor the empty string.

    Spark's CSV reader already turns empty fields into NULL; other sources
    need the second test.  A blank-only value is present.
    """
    c = _col(c)
    return c.isNotNull() & (c != F.lit(""))


def seeded_key(seed: int, *cols: Column | str) -> Column:
    """md5 hex of ``seed:col1:col2...``: a reproducible pseudo-random order
    key that depends on the row's values only, not on partitioning."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[_col(c).cast("string") for c in cols]))


def seeded_bucket(seed: int, *cols: Column | str, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of :func:`seeded_key`.

    DuckDB equivalent: ``('0x' || substr(md5(...), 1, 8))::BIGINT % buckets``.
    """
    hi = F.conv(F.substring(seeded_key(seed, *cols), 1, 8), 16, 10).cast("bigint")
    return F.pmod(hi, F.lit(buckets))


def items_string(c: Column | str, sep: str = " ") -> Column:
    """Sorted array rendered as one string, a total order for item arrays."""
    return F.array_join(F.array_sort(_col(c)), sep)
