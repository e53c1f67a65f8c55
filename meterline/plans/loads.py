"""Load pipelines: raw files to the lake, and the monthly insert-only load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from meterline.operators import tables
from meterline.sources.files import file_name, read_csv, read_monthly
from meterline.sources.layout import write_partitioned
from meterline.workspace import materialize


def ingest_months(
    spark: SparkSession, root: str, lake: str, schema: StructType, taxi_type: str,
    years: Sequence[int] = (), mode: str = "overwrite",
) -> DataFrame:
    """Typed CSV files of all months to Parquet folders by year and month.

    One read covers the whole tree; year and month come from the file names. A
    rerun replaces the months it finds and leaves the others alone. A file holds one
    month, so that its rows go to the lake without a shuffle.
    """
    monthly = read_monthly(spark, root, schema, taxi_type, years=years)
    write_partitioned(monthly.drop("source_file", "taxi_type"), lake, ["year", "month"], mode, gathered=True, codec="zstd")
    return spark.read.parquet(lake)


def load_month(
    spark: SparkSession, table: str, files: str | Sequence[str], schema: StructType,
    pickup: str, dropoff: str, warehouse: bool = False, path: str | None = None, unit: str = "month",
) -> None:
    """Stage one month of CSV, add row hash and file name, and insert the unknown rows.

    Loading the same files again inserts nothing. Equal rows inside one load are
    all inserted, since the merge only looks at what the table held before.
    The warehouse form hashes fewer columns to bytes. Tables are partitioned by the
    pickup's month or day (``unit``), and the merge reads only the periods the load has.
    Rows of one monthly file lie together already: only days are gathered by a shuffle.
    """
    landing = read_csv(spark, files, schema)
    identify = tables.with_warehouse_identity if warehouse else tables.with_landing_identity
    staged = identify(landing, pickup, dropoff, file_name()).withColumn("pickup_period", F.date_trunc(unit, pickup).cast("date"))
    staged = materialize(staged, "staged-month", codec="zstd")
    tables.create_table(spark, table, staged.schema, ["pickup_period"], path, codec="zstd")
    tables.merge_into_table(spark, table, staged, "unique_row_id", "pickup_period", [] if unit == "month" else ["pickup_period"])


def loaded_rows_like(table: DataFrame, filename_regex: str) -> DataFrame:
    """Number of loaded rows whose file name matches."""
    return table.filter(F.col("filename").rlike(filename_regex)).agg(F.count("*").alias("n_rows"))
