"""Session windows over stored data, cheap for hot keys and for no key at all.

Time is cut into cells as wide as the gap. Events of one cell always share a
session, so each cell is reduced to its first and last event before the shuffle,
and sessions are built from cells. A new session starts where an event comes more
than one gap after the one before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterline.workspace import materialize

CELLS_PER_CHUNK = 4096


def _cells(df: DataFrame, ts: str, gap_seconds: int, keys: Sequence[str]) -> DataFrame:
    gap = gap_seconds * 1_000_000
    micros = F.unix_micros(ts)
    cell = F.call_function("div", micros - F.pmod(micros, F.lit(gap)), F.lit(gap))
    return df.filter(F.col(ts).isNotNull()).groupBy(*keys, cell.alias("_cell")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count("*").alias("_n")
    )


def _gap(gap_seconds: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(gap_seconds))


def _starts(previous: Column, gap_seconds: int) -> Column:
    """The cell's first event where a session starts there, else NULL."""
    return F.when(previous.isNull() | (F.col("_first") > previous + _gap(gap_seconds)), F.col("_first"))


def sessions(df: DataFrame, ts: str, gap_seconds: int, keys: Sequence[str], count: str = "n") -> DataFrame:
    """Sessions per key: start, end (last event plus gap) and number of events."""
    in_key = Window.partitionBy(*keys).orderBy("_cell")
    so_far = in_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = _cells(df, ts, gap_seconds, keys).withColumn("_start", _starts(F.lag("_last").over(in_key), gap_seconds))
    assigned = marked.withColumn("session_start", F.last("_start", ignorenulls=True).over(so_far))
    return assigned.groupBy(*keys, "session_start").agg(
        (F.max("_last") + _gap(gap_seconds)).alias("session_end"), F.sum("_n").alias(count)
    )


def _global_sessions(cells: DataFrame, gap_seconds: int) -> DataFrame:
    """Session start of every cell, over all events together.

    Cells are linked within chunks of consecutive cells first. Only one row per
    chunk is then ordered as a whole, to link each chunk to the one before it.
    """
    chunked = cells.withColumn("_chunk", F.floor(F.col("_cell") / CELLS_PER_CHUNK))
    all_chunks = Window.orderBy("_chunk")
    last_events = chunked.groupBy("_chunk").agg(F.max("_last").alias("_chunk_last")).select(
        "_chunk", F.lag("_chunk_last").over(all_chunks).alias("_before_chunk")
    )
    in_chunk = Window.partitionBy("_chunk").orderBy("_cell")
    so_far = in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    previous = F.coalesce(F.lag("_last").over(in_chunk), F.col("_before_chunk"))
    marked = chunked.join(last_events, "_chunk").withColumn("_start", _starts(previous, gap_seconds))
    linked = materialize(marked.withColumn("_own", F.last("_start", ignorenulls=True).over(so_far)), "session-cells")
    open_starts = linked.groupBy("_chunk").agg(F.max("_own").alias("_chunk_start")).select(
        "_chunk",
        F.last("_chunk_start", ignorenulls=True)
        .over(all_chunks.rowsBetween(Window.unboundedPreceding, -1)).alias("_open"),
    )
    return linked.join(open_starts, "_chunk").select(
        "_cell", "_last", F.coalesce("_own", "_open").alias("session_start")
    )


def global_session_pairs(df: DataFrame, ts: str, gap_seconds: int, keys: Sequence[str], count: str = "trip_count") -> DataFrame:
    """Sessions over all events, then events per session and key.

    The session ignores the key; the count is taken per key within it.
    """
    by_key = materialize(_cells(df, ts, gap_seconds, keys), "key-cells")
    cells = by_key.groupBy("_cell").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    assigned = materialize(_global_sessions(cells, gap_seconds), "cell-sessions")
    ends = assigned.groupBy("session_start").agg((F.max("_last") + _gap(gap_seconds)).alias("session_end"))
    counted = by_key.join(assigned.select("_cell", "session_start"), "_cell").groupBy("session_start", *keys).agg(
        F.sum("_n").alias(count)
    )
    return counted.join(ends, "session_start").select("session_start", "session_end", *keys, count)


def longest_streaks(sessions_df: DataFrame, keys: Sequence[str], length: str = "streak_length") -> DataFrame:
    """Longest session per key, the longest first."""
    return sessions_df.groupBy(*keys).agg(F.max(length).alias("longest_streak")).orderBy(
        F.col("longest_streak").desc(), *keys
    )
