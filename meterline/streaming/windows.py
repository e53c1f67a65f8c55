"""Event-time windows that take a batch or a streaming frame alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Declare the event-time column and how late rows may come; no effect on a batch."""
    return df.withWatermark(ts, delay) if df.isStreaming else df


def tumbling_hits(events: DataFrame, ts: str, key: str, width: str = "1 minute") -> DataFrame:
    """Events per window start and key. ``event_hour`` holds the window's start, whatever its width."""
    counted = events.groupBy(F.window(ts, width).alias("w"), F.col(key)).agg(F.count("*").alias("num_hits"))
    return counted.select(F.col("w.start").alias("event_hour"), key, "num_hits")


def session_streaks(trips: DataFrame, ts: str, keys: Sequence[str], gap: str = "5 minutes", count: str = "streak_length") -> DataFrame:
    """Sessions per key: start, end (last event plus gap) and number of events."""
    counted = trips.groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count("*").alias(count))
    return counted.select(
        *keys, count, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end")
    )
