"""JSON messages: shaping rows for a topic and reading them back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.functions.temporal import from_epoch_millis, parse_event_time
from meterline.schemas import EVENT_MESSAGE, TRIP_MESSAGE

FILES_PER_TRIGGER = 100
# A compressed file is one task's work, so none holds more messages.
MESSAGES_PER_FILE = 1_000_000


def to_messages(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One JSON text per row, in column ``value``."""
    return df.select(F.to_json(F.struct(*columns)).alias("value"))


def write_message_files(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Replay messages as compressed text files of bounded length, the broker-free form of a topic."""
    writer = messages.select("value").write.mode(mode).option("maxRecordsPerFile", MESSAGES_PER_FILE)
    writer.option("compression", "gzip").text(path)


def read_message_files(spark: SparkSession, path: str, files_per_trigger: int | None = FILES_PER_TRIGGER) -> DataFrame:
    """Stream of messages from a folder of text files, a bounded number of files per micro-batch.

    Files come in the order they were written in, so a job's watermark must allow for the
    disorder between files. None takes all waiting files as one micro-batch.
    """
    reader = spark.readStream.schema("value string")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def parse_events(messages: DataFrame) -> DataFrame:
    """Events with their time; works on a batch and on a stream of messages."""
    fields = messages.select(F.from_json("value", EVENT_MESSAGE).alias("m")).select("m.*")
    return fields.withColumn("event_time", from_epoch_millis(F.col("event_timestamp")))


def parse_trips(messages: DataFrame) -> DataFrame:
    """Trips with the drop-off time as event time; unreadable times are NULL."""
    fields = messages.select(F.from_json("value", TRIP_MESSAGE).alias("m")).select("m.*")
    return fields.withColumn("dropoff_time", parse_event_time(F.col("lpep_dropoff_datetime")))
