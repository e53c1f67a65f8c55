"""Late rows of a stream: told apart by a mark that each micro-batch leaves, kept, and counted where still allowed.

The mark of a micro-batch is the greatest event time of all micro-batches before it. A row that lies
more than delay and allowed lateness behind it goes to a table of its own with that mark; a row
within the allowed lateness corrects the windows that were given out already. Counts are kept as
one increment per micro-batch, window and key, so a correction reads nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.streaming.windows import tumbling_hits
from meterline.workspace import exists


def keep_late(path: str, ts: str, key: str, width: str, delay_seconds: float, lateness_seconds: float) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: windows, late rows and the mark of a micro-batch below ``path``.

    Each micro-batch owns its folders and reads the mark of the one before, so a replay overwrites
    what it left. Rows without an event time are late, as no window can hold them.
    """

    def store(batch: DataFrame, number: int) -> None:
        spark, before = batch.sparkSession, f"{path}/marks/batch={number - 1}"
        mark = spark.read.schema("mark timestamp").parquet(before).first().mark if number and exists(spark, before) else None
        behind = F.lit(mark).cast("timestamp") - F.make_dt_interval(secs=F.lit(delay_seconds + lateness_seconds))
        late = F.col(ts).isNull() | F.coalesce(F.col(ts) < behind, F.lit(False))
        batch.filter(late).withColumn("mark", F.lit(mark).cast("timestamp")).write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        tumbling_hits(batch.filter(~late), ts, key, width).write.mode("overwrite").parquet(f"{path}/windows/batch={number}")
        batch.agg(F.greatest(F.max(ts), F.lit(mark).cast("timestamp")).alias("mark")).write.mode("overwrite").parquet(f"{path}/marks/batch={number}")

    return store


def corrected_windows(spark: SparkSession, path: str, keys: Sequence[str], count: str = "num_hits") -> DataFrame:
    """The windows as all micro-batches so far have made them."""
    return spark.read.parquet(f"{path}/windows").groupBy(*keys).agg(F.sum(count).alias(count))


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that came too late, with the mark they missed and their micro-batch."""
    return spark.read.parquet(f"{path}/late")
