"""Trip sources derived from the star-schema tables (lineitem, orders, ...).

Each line item is one trip: the order gives the pickup time, the customer's
nation the pickup zone and the supplier's nation the drop-off zone. Money is
held in short decimals, which sum exactly and stay on the fast path.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.functions.text import zero_padded
from meterline.schemas import TABLES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables; the declared schema saves a job that infers it."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def paths(sf_dir: str, *names: str) -> list[str]:
    """Where the given tables are."""
    return [f"{sf_dir}/{name}.parquet" for name in names]


TRIP_TABLES = ("lineitem", "orders", "customer", "supplier")


def trips(
    spark: SparkSession, sf_dir: str, only: str | None = None, first: date | None = None, end: date | None = None,
    by: str | None = None,
) -> DataFrame:
    """Trips of both services, in one neutral layout.

    Orders meet customers first, so that the long trip side is shuffled once
    for its order and once for its supplier, and never for the customer.

    ``only`` is a condition on line items, such as one service's. With ``first`` and ``end``
    orders are left out that cannot have a trip with a pickup or drop-off from the first day up
    to, but without, the end day: a pickup follows its order within a day, a drop-off within two.
    Both reach the files' statistics; the caller still filters the times themselves.
    ``by`` gathers the rows of each value of an expression over the pickup time. They are dealt before the
    other columns are derived, which make a row twice as wide.
    """
    ordered, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    if first is not None:
        ordered = ordered.filter(F.col("o_orderdate") >= F.lit(first - timedelta(days=2)).cast("timestamp_ntz"))
    if end is not None:
        ordered = ordered.filter(F.col("o_orderdate") < F.lit(end).cast("timestamp_ntz"))
    if only is not None:
        items = items.filter(only)
    orders = ordered.join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    joined = (
        items
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    # Written as SQL text: one call to the JVM instead of hundreds.
    joined = joined.selectExpr("*", f"{_PICKUP} AS pickup_datetime")
    if by is not None:
        joined = joined.withColumn("_by", F.expr(by)).hint("rebalance", F.col("_by"))
    return (
        joined.selectExpr("*", *(f"{sql} AS {name}" for name, sql in _BASICS.items()))
        .selectExpr("*", *(f"{sql} AS {name}" for name, sql in _DERIVED.items()))
        .selectExpr(*_LAYOUT)
    )


_PICKUP = """timestampadd(SECOND, CAST((l_orderkey % 24) * 3600 + (l_suppkey % 60) * 60 AS INT),
    CAST(o_orderdate AS TIMESTAMP))"""
_BASICS = {
    "price": "CAST(l_extendedprice AS DECIMAL(12,2))",
    "extra": "CAST(l_tax AS DECIMAL(4,2))",
    "mta_tax": "CAST(0.50 AS DECIMAL(4,2))",
    "tolls_amount": "CAST(0 AS DECIMAL(12,2))",
    "improvement_surcharge": "CAST(0.30 AS DECIMAL(4,2))",
    "congestion_surcharge": "CAST(2.50 AS DECIMAL(4,2))",
}
_DERIVED = {
    "dropoff_datetime": "timestampadd(SECOND, CAST(l_quantity * 60 + l_partkey % 60 AS INT), pickup_datetime)",
    "fare_amount": "CAST(IF(l_partkey % 50 = 0, 0, price) AS DECIMAL(12,2))",
    "tip_amount": "CAST(price * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(17,4))",
}
_LAYOUT = [
    "IF(l_linestatus = 'O', 'Green', 'Yellow') AS service",
    "CAST(nullif(l_linenumber % 4, 0) AS INT) AS vendorid",
    "pickup_datetime",
    "dropoff_datetime",
    "IF(l_partkey % 2 = 0, 'Y', 'N') AS store_and_fwd_flag",
    "concat(CAST(l_partkey % 6 + 1 AS STRING), '.0') AS ratecodeid",
    "c_nationkey AS pulocationid",
    "s_nationkey AS dolocationid",
    "l_linenumber AS passenger_count",
    "l_quantity / 4 AS trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "IF(l_suppkey % 3 = 0, CAST(1.25 AS DECIMAL(4,2)), NULL) AS ehail_fee",
    "improvement_surcharge",
    """CAST(fare_amount + extra + mta_tax + tip_amount + tolls_amount + improvement_surcharge AS DECIMAL(18,4))
        AS total_amount""",
    "concat(substring(o_orderpriority, 1, 1), '.0') AS payment_type",
    "concat(CAST(l_suppkey % 2 + 1 AS STRING), '.0') AS trip_type",
    "congestion_surcharge",
    "l_returnflag",
    "l_suppkey",
    "l_linenumber",
]

# A line item is one service's trip or the other's by its status.
GREEN, YELLOW = "l_linestatus = 'O'", "l_linestatus <> 'O' OR l_linestatus IS NULL"

# The columns of the trip files, in their order.
GREEN_COLUMNS = [
    "vendorid", "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "ratecodeid",
    "pulocationid", "dolocationid", "passenger_count", "trip_distance", "fare_amount", "extra",
    "mta_tax", "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge",
    "total_amount", "payment_type", "trip_type", "congestion_surcharge",
]
YELLOW_COLUMNS = [
    "vendorid", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
    "ratecodeid", "store_and_fwd_flag", "pulocationid", "dolocationid", "payment_type",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount", "congestion_surcharge",
]


def green_trips(
    spark: SparkSession, sf_dir: str, first: date | None = None, end: date | None = None, by: str | None = None,
) -> DataFrame:
    """Raw green trips; pickup and drop-off carry the ``lpep_`` prefix."""
    return (
        trips(spark, sf_dir, GREEN, first, end, by)
        .select(GREEN_COLUMNS)
        .withColumnsRenamed(
            {"pickup_datetime": "lpep_pickup_datetime", "dropoff_datetime": "lpep_dropoff_datetime"}
        )
    )


def yellow_trips(
    spark: SparkSession, sf_dir: str, first: date | None = None, end: date | None = None, by: str | None = None,
) -> DataFrame:
    """Raw yellow trips; pickup and drop-off carry the ``tpep_`` prefix."""
    return (
        trips(spark, sf_dir, YELLOW, first, end, by)
        .select(YELLOW_COLUMNS)
        .withColumnsRenamed(
            {"pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime"}
        )
    )


def fhv_trips(spark: SparkSession, sf_dir: str, first: date | None = None, end: date | None = None) -> DataFrame:
    """Raw for-hire trips: returned-flag N rows, some without a base number."""
    base = F.concat(F.lit("B"), zero_padded(F.col("l_suppkey").cast("string"), 5))
    return trips(spark, sf_dir, "l_returnflag = 'N'", first, end).select(
        F.when(F.col("l_suppkey") % 10 != 0, base).alias("dispatching_base_num"),
        "pickup_datetime",
        "dropoff_datetime",
        F.col("pulocationid").alias("PULocationID"),
        F.col("dolocationid").alias("DOLocationID"),
        F.when(F.col("l_linenumber") % 3 == 0, "1").alias("SR_Flag"),
    )


def zone_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup: nations as zones, regions as boroughs."""
    joined = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return joined.select(
        F.col("n_nationkey").alias("locationid"),
        F.when(F.col("r_name") == "MIDDLE EAST", "Unknown").otherwise(F.col("r_name")).alias("borough"),
        F.col("n_name").alias("zone"),
        F.when(F.col("r_name") == "AFRICA", "EWR")
        .when(F.col("r_name").isin("AMERICA", "ASIA"), "Boro Zone")
        .otherwise("Yellow Zone")
        .alias("service_zone"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events with a zoned event time."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
