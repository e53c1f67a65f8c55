"""Sessions that streams run in."""

from __future__ import annotations

from pyspark.sql import SparkSession

from meterline.session import configure

ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session with its own settings, sharing the context.

    A stream keeps the number of state partitions of its first start for life.
    Without a number the session's shuffle setting holds. State lies in RocksDB, on disk beside the
    executor and as changes in the checkpoint, so that it is bounded by neither heap nor batch.
    """
    sibling = configure(spark.newSession())
    partitions = state_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sibling.conf.set("spark.sql.shuffle.partitions", str(partitions))
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)
    sibling.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return sibling
