"""Structured Streaming variants of the batch operators."""

from larch.streaming.counts import value_counts_stream
from larch.streaming.sessions import session_stream

__all__ = ["session_stream", "value_counts_stream"]
