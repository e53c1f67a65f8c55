"""Sources and sinks that need a connector or a running service.

Each function only passes options to Spark's reader or writer. The connector jars
and services are not part of this repository; see the README.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession, url: str, query_or_table: str, partition_column: str, lower: object, upper: object,
    partitions: int, properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a table or a parenthesised query in ranges of a column, one connection and task per range.

    The bounds only place the ranges: rows outside them are read by the first and last task.
    """
    return (
        spark.read.format("jdbc").option("url", url).option("dbtable", query_or_table)
        .option("partitionColumn", partition_column).option("lowerBound", str(lower))
        .option("upperBound", str(upper)).option("numPartitions", partitions)
        .options(**dict(properties or {})).load()
    )


def append_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = 10_000, properties: Mapping[str, str] | None = None) -> None:
    """Append rows; every task writes its own batches."""
    (
        df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
        .option("batchsize", batch_rows).options(**dict(properties or {})).save()
    )


def replace_jdbc(df: DataFrame, url: str, table: str, keep_definition: bool = True, properties: Mapping[str, str] | None = None) -> None:
    """Replace all rows; the table's definition is kept unless told otherwise."""
    (
        df.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", table)
        .option("truncate", keep_definition).options(**dict(properties or {})).save()
    )


def write_warehouse(df: DataFrame, table: str, scratch_bucket: str, mode: str = "overwrite", file_format: str = "bigquery") -> None:
    """Write to a cloud warehouse through its Spark connector."""
    df.write.format(file_format).mode(mode).option("table", table).option("temporaryGcsBucket", scratch_bucket).save()


def kafka_options(servers: str, topic: str, starting: str = "earliest", max_per_trigger: int | None = None) -> dict[str, str]:
    """Options of a topic source. ``starting`` counts only for a new checkpoint."""
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_topic(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", max_per_trigger: int | None = None) -> DataFrame:
    """Messages of a topic as text in column ``value``."""
    return (
        spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting, max_per_trigger))
        .load().selectExpr("CAST(value AS STRING) AS value")
    )


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Send a ``value`` text column to a topic, as a batch."""
    messages.select("value").write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def object_store_settings(scheme: str, key_file: str) -> dict[str, str]:
    """Session settings for reading ``scheme://`` paths with a service-account key file."""
    prefix = "spark.hadoop.google.cloud.auth.service.account"
    return {
        f"spark.hadoop.fs.{scheme}.impl": "com.google.cloud.hadoop.fs.gcs.GoogleHadoopFileSystem",
        f"spark.hadoop.fs.AbstractFileSystem.{scheme}.impl": "com.google.cloud.hadoop.fs.gcs.GoogleHadoopFS",
        f"{prefix}.enable": "true",
        f"{prefix}.json.keyfile": key_file,
    }
