"""Event time, calendar parts and durations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Text of another shape is turned away first, as a failed parse costs an exception.
_EVENT_TIME_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def from_epoch_millis(millis: Column) -> Column:
    """Instant of an epoch-millisecond number; fractions of a millisecond are dropped."""
    return F.timestamp_millis(millis.cast("bigint"))


def parse_event_time(text: Column) -> Column:
    """Timestamp of ``yyyy-MM-dd HH:mm:ss`` text, NULL for anything else."""
    return F.when(text.rlike(_EVENT_TIME_SHAPE), F.try_to_timestamp(text, F.lit(EVENT_TIME_FORMAT)))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two instants."""
    return F.timestamp_diff("SECOND", start, end)


def fractional_hours(start: Column, end: Column) -> Column:
    """Hours between two instants, both cut to the second."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(3600)


def month_start(ts: Column) -> Column:
    return F.date_trunc("month", ts)


def hour_start(ts: Column) -> Column:
    return F.date_trunc("hour", ts)
