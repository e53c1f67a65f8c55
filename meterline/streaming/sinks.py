"""Stream sinks: append, keyed upsert, fan-out."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

# How often a running stream commits its progress.
TRIGGER = "10 seconds"


def _start(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER)
    return writer.start()


def append_parquet(stream: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append finished rows to Parquet, exactly once.

    ``available_now`` works off what is there and stops, which also resumes a
    stopped stream from its checkpoint.
    """
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", path)
    return _start(writer, checkpoint, available_now)


def drain_parquet(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append all that waits to Parquet, one micro-batch right after the other, and stop.

    For sources whose ``available_now`` run takes one bounded micro-batch: a query is started once, not
    once per micro-batch.
    """
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", path)
    run = writer.option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    try:
        run.processAllAvailable()
    finally:
        run.stop()


def print_rows(stream: DataFrame, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Show each micro-batch on the console."""
    return _start(stream.writeStream.outputMode("append").format("console"), checkpoint, available_now)


def upsert_parquet(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = False, output_mode: str = "update",
    compact_every: int = 0, keys: Sequence[str] = (),
) -> StreamingQuery:
    """Keep changed rows per micro-batch, for ``current_rows`` to collapse by key.

    Each micro-batch owns one folder and overwrites it, so a replayed batch leaves
    no second copy, and the cost of a batch does not grow with the table. With
    ``compact_every`` the folders are collapsed by ``keys`` after every so many
    batches, so reading does not grow with the number of batches either.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact(batch.sparkSession, path, keys)

    writer = stream.writeStream.outputMode(output_mode).foreachBatch(store)
    return _start(writer, checkpoint, available_now)


def current_rows(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The upserted table: for every key, the row of its latest micro-batch."""
    stored = spark.read.parquet(path)
    values = [name for name in stored.columns if name not in (*keys, "batch")]
    order = F.col("batch").cast("double")
    latest = stored.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("latest"))
    return latest.select(*keys, "latest.*")


def batch_numbers(spark: SparkSession, path: str) -> list[str]:
    """Numbers of the finished batch folders, ascending; a half marks a compacted one."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in system.listStatus(root)]
    numbers = [
        name.removeprefix("batch=") for name in names
        if name.startswith("batch=") and system.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/_SUCCESS"))
    ]
    return sorted(numbers, key=float)


def compact(spark: SparkSession, path: str, keys: Sequence[str]) -> None:
    """Replace all batch folders by one that holds the current rows.

    The new folder is numbered half a step above the newest batch and complete before
    the old ones go: until then both give the same rows, and so does a replay of the
    newest batch. Call it from the stream's own batches or while the stream stands
    still; a reader that began before may have to start again.
    """
    old = batch_numbers(spark, path)
    if len(old) < 2:
        return
    newest = int(float(old[-1]))
    current_rows(spark, path, keys).write.mode("overwrite").parquet(f"{path}/batch={newest}.5")
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for number in old:
        if number != f"{newest}.5":
            system.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch={number}"), True)


def each_batch(stream: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Hand each micro-batch of finished rows with its number to ``store``."""
    return _start(stream.writeStream.outputMode("append").foreachBatch(store), checkpoint, available_now)


def fan_out(stream: DataFrame, sinks: Sequence[Callable[[DataFrame, int], None]], checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Hand each micro-batch to several sinks; the batch is held while they read it."""

    def store(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            for sink in sinks:
                sink(held, batch_id)
        finally:
            held.unpersist()

    return _start(stream.writeStream.outputMode("append").foreachBatch(store), checkpoint, available_now)


class LateRows(StreamingQueryListener):
    """Rows (after pre-aggregation) each run of a query dropped for coming behind the watermark.

    Every progress report is counted as it comes; a query itself remembers only the last ones.
    Register it with ``spark.streams.addListener`` on the session the stream runs in.
    """

    def __init__(self) -> None:
        self._dropped: dict[str, int] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        dropped = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        with self._change:
            run = str(event.progress.runId)
            self._dropped[run] = self._dropped.get(run, 0) + dropped

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def of(self, query: StreamingQuery, patience: float = 60) -> int:
        """Dropped rows of a query that has ended."""
        run = str(query.runId)
        with self._change:
            if not self._change.wait_for(lambda: run in self._ended, patience):
                raise TimeoutError("the end of the query was not reported")
            return self._dropped.get(run, 0)
