"""Streaming variants: cleaning of arriving messages, and sessions per chat that close when the watermark passes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import clean_messages


def clean_stream(messages: DataFrame, **rules) -> DataFrame:
    """Stateless: the same rules as in batch."""
    return clean_messages(messages, **rules)


def session_stream(messages: DataFrame, gap_s: int = 3600, late: str = "2 days", chat: str = "source_file", ts: str = "ts", event_id: str = "msg_id") -> DataFrame:
    """source, start, end, n_messages of closed sessions: neighbours at most gap_s apart belong together.

    ts: a timestamp. Repeated messages within the watermark count once; later ones than late are dropped by the engine.
    Rows without chat or time are left out.
    """
    once = messages.where(F.col(chat).isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, late).dropDuplicatesWithinWatermark([event_id])
    window = F.session_window(ts, f"{gap_s} seconds")
    agg = once.groupBy(F.col(chat).alias("source"), window.alias("w")).agg(F.count("*").alias("n_messages"), F.min(ts).alias("start"), F.max(ts).alias("end"))
    return agg.select("source", "start", "end", "n_messages")
