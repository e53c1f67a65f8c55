"""Layouts and what files say of themselves: footers, buckets, clustering, malformed rows, sketches, catalog functions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.functions.catalog import define_functions, labels_by_sql
from meterline.operators import sketches
from meterline.registry import checks
from meterline.registry.book import query
from meterline.registry.scans import dropoff_date_path, high_volume
from meterline.schemas import HIGH_VOLUME_TRIPS
from meterline.sources import files, footers, layout, roles
from meterline.workspace import built_once, materialize, new_dir


@query(
    "partition_counts_footers",
    f"""WITH {checks.TRIPS} SELECT CAST(dropoff_datetime AS DATE) AS partition_id, count(*) AS total_rows
        FROM trips WHERE service = 'Yellow' GROUP BY 1""",
)
def partition_counts_footers(spark, sf_dir):
    """Rows per date of the stored table, from the footers of its files."""
    return footers.partition_counts(spark, dropoff_date_path(spark, sf_dir), "dropoff_date")


_RANGED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query(
    "column_ranges_footers",
    "SELECT count(*) AS n_rows, " + ", ".join(f"min({name}) AS min_{name}, max({name}) AS max_{name}" for name in _RANGED) + " FROM lineitem",
)
def column_ranges_footers(spark, sf_dir):
    return footers.column_ranges(spark, roles.paths(sf_dir, "lineitem")[0], _RANGED)


@query(
    "file_metadata",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, count(*) AS n_rows, (count(*) - count({name}))::BIGINT AS null_count, min({name})::BIGINT AS low,
            max({name})::BIGINT AS high FROM lineitem""" for name in _RANGED),
)
def file_metadata(spark, sf_dir):
    """Totals of all files of a table, column by column, from what the files state."""
    stated = footers.file_metadata(spark, roles.paths(sf_dir, "lineitem")[0]).filter(F.col("column_name").isin(_RANGED))
    return stated.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("null_count").alias("null_count"),
        F.min(F.col("low").cast("long")).alias("low"), F.max(F.col("high").cast("long")).alias("high"))


def _bucketed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders and line items as tables with the same buckets."""

    def build(name: str, key: str, columns: list[str]) -> DataFrame:
        def write() -> str:
            table = f"{name}_{uuid.uuid4().hex}"
            layout.write_bucketed(roles.table(spark, sf_dir, name).select(columns), table, new_dir(spark, f"bucketed-{name}"), 8, [key])
            return table

        return spark.table(built_once(spark, ("bucketed", sf_dir, name), roles.paths(sf_dir, name), write))

    return (build("orders", "o_orderkey", ["o_orderkey", "o_orderpriority"]),
            build("lineitem", "l_orderkey", ["l_orderkey", "l_quantity"]))


@query(
    "bucketed_join",
    """SELECT o_orderkey, o_orderpriority, count(*) AS lines, sum(l_quantity) AS quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey
       GROUP BY 1, 2""",
)
def bucketed_join(spark, sf_dir):
    """A join and a grouping by the key of the buckets: no row is shuffled."""
    orders, lines = _bucketed(spark, sf_dir)
    joined = orders.hint("merge").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderkey", "o_orderpriority").agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))


def clustered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items clustered by part and supplier together."""

    def write() -> str:
        path = new_dir(spark, "clustered")
        lines = roles.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
        layout.write_clustered(lines, path, ["l_partkey", "l_suppkey"], files=16)
        return path

    return spark.read.parquet(built_once(spark, ("clustered", sf_dir), roles.paths(sf_dir, "lineitem"), write))


@query(
    "clustered_two_columns",
    """WITH ends AS (SELECT max(l_partkey) AS p, max(l_suppkey) AS s FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem, ends WHERE l_partkey <= p // 8 OR l_suppkey <= s // 8""",
)
def clustered_two_columns(spark, sf_dir):
    stored = clustered_lines(spark, sf_dir)
    part, supplier = stored.agg(F.max("l_partkey"), F.max("l_suppkey")).first()
    near = stored.filter(F.col("l_partkey") <= (part or 0) // 8)
    others = stored.filter((F.col("l_suppkey") <= (supplier or 0) // 8) & (F.col("l_partkey") > (part or 0) // 8))
    return near.unionByName(others)


_DECLARED = ["dispatching_base_num", "PULocationID", "DOLocationID"]


def _written_with_faults(spark: SparkSession, sf_dir: str) -> str:
    """CSV lines of for-hire trips, of which some lack a field, have one too many, or hold no number."""
    trips = high_volume(spark, sf_dir)
    kind = (F.col("PULocationID") * 31 + F.col("DOLocationID")) % 50
    base = F.coalesce("dispatching_base_num", F.lit(""))
    pickup, dropoff = F.col("PULocationID").cast("string"), F.col("DOLocationID").cast("string")
    line = (
        F.when(kind == 0, F.concat_ws(",", base, pickup)).when(kind == 1, F.concat_ws(",", base, pickup, dropoff, F.lit('"a,b"')))
        .when(kind == 2, F.concat_ws(",", base, F.lit("unknown"), dropoff)).otherwise(F.concat_ws(",", base, pickup, dropoff))
    )
    path = new_dir(spark, "csv-faults")
    # One raw column whose name is the header line.
    trips.select(line.alias(",".join(_DECLARED))).write.option("header", True).option("sep", "\x01").option("quote", "").csv(path)
    return path


@query(
    "csv_quarantine",
    f"""WITH {checks.FHV}, judged AS (SELECT *, (pulocationid * 31 + dolocationid) % 50 AS kind FROM fhv)
        SELECT CASE kind WHEN 0 THEN 'short' WHEN 1 THEN 'long' WHEN 2 THEN 'unreadable' ELSE 'read' END AS fate, count(*) AS n,
          sum(CASE WHEN kind > 2 THEN pulocationid END)::BIGINT AS pickups FROM judged GROUP BY 1""",
)
def csv_quarantine(spark, sf_dir):
    """Every line of the files is read or set aside with its file and reason."""
    declared = type(HIGH_VOLUME_TRIPS)([HIGH_VOLUME_TRIPS[name] for name in _DECLARED])
    good, bad = files.read_csv_checked(spark, _written_with_faults(spark, sf_dir), declared)
    aside = materialize(bad, "quarantine")
    return good.agg(F.lit("read").alias("fate"), F.count("*").alias("n"), F.sum("PULocationID").cast("long").alias("pickups")).unionByName(
        aside.filter("file IS NOT NULL").groupBy(F.col("reason").alias("fate")).agg(F.count("*").alias("n"), F.lit(None).cast("long").alias("pickups")))


def _stored_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write() -> str:
        path = new_dir(spark, "sketches")
        daily = roles.trips(spark, sf_dir).withColumn("day", F.to_date("pickup_datetime"))
        sketches.distinct_sketches(daily, ["day"], "pulocationid").write.parquet(path)
        return path

    return spark.read.parquet(built_once(spark, ("sketches", sf_dir), roles.paths(sf_dir, *roles.TRIP_TABLES), write))


@query(
    "distinct_by_sketch",
    f"WITH {checks.TRIPS} SELECT year(pickup_datetime)::INTEGER AS year, count(DISTINCT pulocationid) AS pickups FROM trips GROUP BY 1",
)
def distinct_by_sketch(spark, sf_dir):
    """Estimated pickup zones of every year, merged from the sketches of its days."""
    yearly = _stored_sketches(spark, sf_dir).withColumn("year", F.year("day"))
    return sketches.merged_estimate(yearly, ["year"], "pickups")


@query(
    "sql_functions",
    f"WITH {checks.TRIPS} SELECT payment_type, {checks.LABEL} AS description, count(*) AS n FROM trips GROUP BY 1, 2",
)
def sql_functions(spark, sf_dir):
    """SQL text that calls the session's own functions."""
    define_functions(spark)
    view = f"trips_{uuid.uuid4().hex}"
    roles.trips(spark, sf_dir).select("payment_type").createOrReplaceTempView(view)
    return labels_by_sql(spark, view, "payment_type")
