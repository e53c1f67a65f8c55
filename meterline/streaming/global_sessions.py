"""Sessions over all keys of a stream, without gathering the stream under one key.

Time is cut into ranges longer than the gap, and the state of the stream is kept per range. An event
near a border is also shown to the range beyond it, so a range knows whether its first and last
session go on there. Events are added to a range's state as reduced chunks (one row per gap-wide cell
and key), which are only read when a timer behind the range's end closes it; then its pieces of
sessions are given out and its state is dropped. The state of a stream is what its open ranges hold.

``link_closed`` joins pieces across borders: only pieces that touch a border, two a range, and
the one session that is still open are looked at together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from meterline.workspace import exists

# The sides an event is shown on: its own range, or the neighbour before or behind which it lies.
OWN, BEFORE, BEHIND = 0, -1, 1


def _spread(events: DataFrame, ts: str, gap: int, width: int, keys: Sequence[str]) -> DataFrame:
    """Events with the range they are shown to; those near a border a second time."""
    micros = F.unix_micros(ts)
    offset = F.pmod(micros, F.lit(width))
    own = F.call_function("div", micros - offset, F.lit(width))
    shown = F.array_compact(F.array(
        F.struct(own.alias("range"), F.lit(OWN).alias("side")),
        F.when(offset <= gap, F.struct((own - 1).alias("range"), F.lit(BEHIND).alias("side"))),
        F.when(width - offset <= gap, F.struct((own + 1).alias("range"), F.lit(BEFORE).alias("side"))),
    ))
    known = events.filter(F.col(ts).isNotNull())
    return known.select(ts, *keys, micros.alias("micros"), F.explode(shown).alias("shown")).select(
        ts, *keys, "micros", "shown.range", "shown.side")


class RangeSessions(StatefulProcessor):
    """Pieces of sessions of one range, given out when its timer fires."""

    def __init__(self, gap: int, width: int, keys: Sequence[str]) -> None:
        self.gap, self.width, self.keys = gap, width, list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getListState("chunks", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        whole = pd.concat(list(rows), ignore_index=True)
        whole["cell"] = whole["micros"] // self.gap
        reduced = whole.groupby(["side", "cell", *self.keys], dropna=False, as_index=False).agg(
            first=("micros", "min"), last=("micros", "max"), n=("micros", "size"))
        sink = pa.BufferOutputStream()
        table = pa.Table.from_pandas(reduced, preserve_index=False)
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        self.chunks.appendValue((sink.getvalue().to_pybytes(),))
        # Nothing that is not late can reach the range once the watermark is a gap beyond its end.
        self.handle.registerTimer(max(((key[0] + 1) * self.width + self.gap) // 1000 + 1, 0))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        chunks = [pa.ipc.open_stream(bytes(row[0])).read_pandas() for row in self.chunks.get()]
        self.chunks.clear()
        found = pieces(pd.concat(chunks, ignore_index=True), self.gap, self.keys)
        if len(found):
            found.insert(0, "range", key[0])
            yield found

    def close(self) -> None:
        pass


def pieces(cells: pd.DataFrame, gap: int, keys: Sequence[str]) -> pd.DataFrame:
    """Pieces of sessions from reduced events, one row per piece and key."""
    before = cells.loc[cells["side"] == BEFORE, "last"].max()
    behind = cells.loc[cells["side"] == BEHIND, "first"].min()
    own = cells[cells["side"] == OWN]
    if not len(own):
        return pd.DataFrame()
    spans = own.groupby("cell").agg(first=("first", "min"), last=("last", "max")).sort_index()
    spans["piece"] = (spans["first"] - spans["last"].shift() > gap).cumsum()
    heads = spans.groupby("piece").agg(first=("first", "min"), last=("last", "max"))
    heads["goes_on_before"] = [k == 0 and pd.notna(before) and first - before <= gap for k, first in enumerate(heads["first"])]
    heads["goes_on_behind"] = [k == len(heads) - 1 and pd.notna(behind) and behind - last <= gap for k, last in enumerate(heads["last"])]
    counted = own.join(spans["piece"], on="cell").groupby(["piece", *keys], dropna=False, as_index=False)["n"].sum()
    return counted.join(heads, on="piece")[["piece", "first", "last", "goes_on_before", "goes_on_behind", *keys, "n"]]


def _piece_schema(events: DataFrame, keys: Sequence[str]) -> T.StructType:
    head = T.StructType.fromDDL("range long, piece long, first long, last long, goes_on_before boolean, goes_on_behind boolean")
    return T.StructType([*head.fields, *(events.schema[name] for name in keys), T.StructField("n", T.LongType())])


def session_pieces(events: DataFrame, ts: str, gap_seconds: int, range_seconds: int, keys: Sequence[str]) -> DataFrame:
    """Stream of the session pieces of closed ranges; ``events`` has a watermark on ``ts``."""
    if range_seconds <= gap_seconds:
        raise ValueError("a range must be longer than the gap")
    gap, width = gap_seconds * 1_000_000, range_seconds * 1_000_000
    return _spread(events, ts, gap, width, keys).groupBy("range").transformWithStateInPandas(
        RangeSessions(gap, width, keys), _piece_schema(events, keys), "append", "EventTime")


def _open_schema(batch: DataFrame, keys: Sequence[str]) -> T.StructType:
    return T.StructType([*T.StructType.fromDDL("start long, last long").fields, *(batch.schema[name] for name in keys), batch.schema["n"]])


def link_closed(path: str, gap_seconds: int, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: write the sessions that a micro-batch completes below ``path``.

    Each micro-batch owns its folders: the pieces it brought, the sessions it completed, and the session it left open. A
    replayed micro-batch starts from the folder of the one before it and overwrites its own.
    """

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        at = f"{path}/pieces/batch={number}"
        batch.write.mode("overwrite").parquet(at)
        found = spark.read.schema(batch.schema).parquet(at)
        schema, left = _open_schema(batch, keys), f"{path}/open/batch={number - 1}"
        still = spark.read.schema(schema).parquet(left) if number and exists(spark, left) else spark.createDataFrame([], schema)
        touching = found.filter("goes_on_before or goes_on_behind")
        heads = touching.select("range", "piece", "first", "last", "goes_on_before", "goes_on_behind").distinct().unionByName(
            still.groupBy("start").agg(F.max("last").alias("last")).select(
                F.lit(None).cast("long").alias("range"), F.lit(None).cast("long").alias("piece"), F.col("start").alias("first"), "last",
                F.lit(False).alias("goes_on_before"), F.lit(True).alias("goes_on_behind")))
        so_far = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        linked = heads.withColumn("start", F.last(F.when(~F.col("goes_on_before"), F.col("first")), ignorenulls=True).over(so_far))
        ends = linked.groupBy("start").agg(F.max("last").alias("last"), F.max_by("goes_on_behind", "first").alias("is_open"))
        counts = touching.join(linked.select("range", "piece", "start"), ["range", "piece"]).select("start", *keys, "n").unionByName(
            still.select("start", *keys, "n"))
        chained = counts.groupBy("start", *keys).agg(F.sum("n").alias("n")).join(ends, "start")
        chained.filter("is_open").select("start", "last", *keys, "n").write.mode("overwrite").parquet(f"{path}/open/batch={number}")
        alone = found.filter("not goes_on_before and not goes_on_behind").select(F.col("first").alias("start"), "last", *keys, "n")
        closed = alone.unionByName(chained.filter("not is_open").select("start", "last", *keys, "n"))
        closed.select(
            F.timestamp_micros("start").alias("session_start"), F.timestamp_micros(F.col("last") + gap_seconds * 1_000_000).alias("session_end"),
            *keys, "n").write.mode("overwrite").parquet(f"{path}/sessions/batch={number}")

    return store


def closed_sessions(spark: SparkSession, path: str, count: str = "trip_count") -> DataFrame:
    """Every completed session: start, end (last event plus gap), and events per key."""
    return spark.read.parquet(f"{path}/sessions").drop("batch").withColumnRenamed("n", count)
