"""Table maintenance on plain Parquet: merges, identities, replacement.

Parquet tables know no MERGE, UPDATE or DELETE. The functions below compute the
rows a statement would add or leave; ``replace_table`` and ``append_rows`` store them
without overwriting anything the plan still reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterline.functions.keys import row_hash, row_hash_bytes
from meterline.operators.windows import keep_first
from meterline.workspace import materialize, new_dir


def new_rows(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Source rows whose key the target lacks, duplicates within the source included.

    Rows with a NULL key match nothing and are always new. Only the key column
    of the target is read.
    """
    return source.join(target.select(F.col(key).alias("_known")), F.col(key) == F.col("_known"), "left_anti")


def merge_insert_only(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target after ``MERGE ... WHEN NOT MATCHED THEN INSERT``."""
    return target.unionByName(new_rows(target, source, key))


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """Target with source rows replacing or extending it, one source row per key."""
    # Read twice, by the anti join and by the union: chosen once.
    chosen = materialize(keep_first(source, keys, order), "upsert-rows")
    incoming = chosen.select(*[F.col(key).alias(f"_s_{key}") for key in keys])
    same = [F.col(key).eqNullSafe(F.col(f"_s_{key}")) for key in keys]
    return target.join(incoming, same, "left_anti").unionByName(chosen)


def with_landing_identity(landing: DataFrame, pickup: str, dropoff: str, filename: Column) -> DataFrame:
    """Landing rows with their 7-column hash and file name in front."""
    parts = [pickup, dropoff, "PULocationID", "DOLocationID", "fare_amount", "trip_distance"]
    hashed = row_hash(F.col("VendorID"), *[F.col(name) for name in parts])
    return landing.select(hashed.alias("unique_row_id"), filename.alias("filename"), *landing.columns)


def with_warehouse_identity(landing: DataFrame, pickup: str, dropoff: str, filename: Column) -> DataFrame:
    """Landing rows with the warehouse's binary 5-column hash and file name in front."""
    parts = ["VendorID", pickup, dropoff, "PULocationID", "DOLocationID"]
    hashed = row_hash_bytes(*[F.col(name) for name in parts])
    return landing.select(hashed.alias("unique_row_id"), filename.alias("filename"), *landing.columns)


def create_table(spark: SparkSession, name: str, schema, partitioned_by: Sequence[str] = (), path: str | None = None, codec: str | None = None) -> None:
    """Create an empty Parquet table unless it exists; ``codec`` replaces the session's compression for all its rows."""
    if spark.catalog.tableExists(name):
        return
    writer = spark.createDataFrame([], schema).write.format("parquet")
    if partitioned_by:
        writer = writer.partitionBy(*partitioned_by)
    if codec:
        writer = writer.option("compression", codec)
    writer.option("path", path or new_dir(spark, "table")).saveAsTable(name)


def create_like(spark: SparkSession, name: str, template: str, path: str | None = None) -> None:
    """Create an empty table with the columns of another."""
    create_table(spark, name, spark.table(template).schema, path=path)


def append_rows(df: DataFrame, name: str, balance_by: Sequence[str] = ()) -> None:
    """INSERT INTO by column name; ``balance_by`` gathers the rows of each partition in few files."""
    table = df.sparkSession.table(name)
    rows = df.select(table.columns)
    if balance_by:
        rows = rows.hint("rebalance", *[F.col(column) for column in balance_by])
    rows.write.insertInto(name)


def merge_into_table(
    spark: SparkSession, name: str, source: DataFrame, key: str, within: str | None = None,
    balance_by: Sequence[str] = (),
) -> None:
    """Insert-only merge into a stored table: known rows stay, only new rows are written.

    ``within`` names a column that equal keys share and the table is partitioned by,
    such as the pickup date. Only the partitions that the source has rows of are then
    read, so a month costs a month however long the table's history, and a stray date
    costs that date. The source's values are one per partition it touches. The table's
    files are listed before the append starts, so the append never reads itself.
    """
    target = spark.table(name)
    if within is not None:
        touched = [row[0] for row in source.select(within).distinct().collect()]
        same = F.col(within).isin(*[value for value in touched if value is not None])
        target = target.filter(same | F.col(within).isNull() if None in touched else same)
    append_rows(new_rows(target, source, key), name, balance_by)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace-load: write a new folder, then point the table name at it.

    Readers in between find no table only where the columns change.
    """
    spark = df.sparkSession
    target = path or new_dir(spark, "table")
    df.write.parquet(target)
    if spark.catalog.tableExists(name) and spark.table(name).dtypes == df.dtypes:
        # One catalog operation: readers find the old rows or the new ones, never no table.
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{target}'")
        spark.catalog.refreshTable(name)
        return
    drop_table(spark, name)
    spark.catalog.createTable(name, path=target, source="parquet")


def truncate_table(spark: SparkSession, name: str, schema=None) -> None:
    """Remove all rows and keep the table.

    External tables cannot be truncated, so the name is pointed at an empty folder.
    """
    replace_table(spark.createDataFrame([], schema or spark.table(name).schema), name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
