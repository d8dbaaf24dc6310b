"""Sessions of a stream with late events.

The same rule as :func:`larch.operators.ordered.sessions`: an event more than the gap
after the one before starts a new session.  Sessions live in Spark's state store until
the watermark has passed their end by the gap; an event that is late but within the watermark
still joins, extends or bridges sessions, a later one is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_stream(events: DataFrame, key: str, time: str, gap_seconds: int, late: str, measures: list) -> DataFrame:
    """Streaming ``(key, first, last, *measures)`` of every closed session, for append
    mode.  ``late`` is how far behind the latest event one may come, as an interval.
    Null keys are one key; events without a time are in no session."""
    gap = f"{gap_seconds} seconds"
    # A window ends a gap after its last event, and one that starts there still joins.
    return (events.where(F.col(time).isNotNull()).withWatermark(time, late)
            .groupBy(F.session_window(time, gap).alias("_window"), key)
            .agg(F.min(time).alias("first"), F.max(time).alias("last"), *measures).drop("_window"))
