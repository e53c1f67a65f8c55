"""Queries over a topic: keyed replay, start positions, bounded micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from meterline.registry.book import query
from meterline.sources import roles
from meterline.streaming import sinks, topic
from meterline.workspace import new_dir

PARTITIONS = 4


class Feed:
    """A topic of click events, and one reading group with its checkpoint and sink."""

    def __init__(self, spark: SparkSession, sf_dir: str, label: str, start: str, bound: int = 0):
        self.spark, self.start, self.bound = spark, start, bound
        self.events = roles.events(spark, sf_dir)
        self.path, self.checkpoint, self.out = (new_dir(spark, f"{label}-{part}") for part in ("topic", "cp", "out"))

    def publish(self, events: DataFrame) -> None:
        message = F.to_json(F.struct(F.col("user_id").alias("test_data"), F.unix_micros("ts").alias("at")))
        topic.publish(
            events.select(F.col("user_id").cast("string").alias("key"), message.alias("value"), "ts", "event_id"), self.path, PARTITIONS, ["ts", "event_id"])

    def drain(self) -> None:
        """Take micro-batches until nothing is left."""
        rows = topic.read_topic(self.spark, self.path, PARTITIONS, "replay", self.start, self.bound)
        sinks.drain_parquet(rows, self.out, self.checkpoint)

    def received(self) -> DataFrame:
        fields = F.from_json("value", "test_data bigint, at bigint")
        return self.spark.read.schema(topic.RECORD).parquet(self.out).select(
            "partition", "position", "key", fields["test_data"].alias("test_data"), F.timestamp_micros(fields["at"]).alias("event_timestamp"))


@query(
    "topic_earliest",
    """SELECT user_id AS test_data, ts AS event_timestamp, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 2, ts, event_id) AS nth
       FROM events""",
)
def topic_earliest(spark, sf_dir):
    """Two publications read from the earliest position, some thousand messages at a time; ``nth`` is a message's place within its key."""
    feed = Feed(spark, sf_dir, "earliest", "earliest", bound=40_000)
    feed.publish(feed.events.filter(F.col("event_id") % 2 == 0))
    feed.drain()
    feed.publish(feed.events.filter(F.col("event_id") % 2 == 1))
    feed.drain()
    in_key = Window.partitionBy("key").orderBy("position")
    return feed.received().select("test_data", "event_timestamp", F.row_number().over(in_key).cast("long").alias("nth"))


@query("topic_latest", "SELECT user_id AS test_data, ts AS event_timestamp FROM events WHERE event_id % 2 = 1")
def topic_latest(spark, sf_dir):
    """A group that starts at the latest position sees what is published after its start."""
    feed = Feed(spark, sf_dir, "latest", "latest")
    feed.publish(feed.events.filter(F.col("event_id") % 2 == 0))
    feed.drain()
    feed.publish(feed.events.filter(F.col("event_id") % 2 == 1))
    feed.drain()
    return feed.received().select("test_data", "event_timestamp")
