"""Sources, sinks and layouts, each fed with data Spark derives from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from meterline.functions.casts import numeric
from meterline.operators.aggregates import average_rounded
from meterline.operators.relational import common_columns, with_default_columns
from meterline.operators.tables import append_rows, drop_table
from meterline.plans import loads
from meterline.registry import checks
from meterline.registry.book import query
from meterline.registry.checks import money
from meterline.registry.models import as_double
from meterline.schemas import (
    GREEN_TRIPS, HIGH_VOLUME_TRIPS, LANDING_GREEN, LANDING_YELLOW, PRODUCTS_DOCUMENT, TABLES, YELLOW_TRIPS,
)
from meterline.sources import files, layout, roles
from meterline.streaming.messages import to_messages
from meterline.workspace import built_once, new_dir

# The columns a trip message carries.
TRIP_MESSAGE_COLUMNS = [
    "lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID", "DOLocationID",
    "passenger_count", "trip_distance", "tip_amount",
]


def write_csv(df: DataFrame, label: str, by: str | None = None, codec: str = "none") -> str:
    """Write CSV with a header to the shared folder, optionally one folder per value, whose rows should lie together."""
    path = new_dir(df.sparkSession, label)
    writer = df.write.option("header", True).option("timestampFormat", files.CSV_TIME_FORMAT)
    if by:
        writer = writer.partitionBy(by)
    writer.option("compression", codec).csv(path)
    return path


def high_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For-hire trips in the high-volume layout."""
    return roles.fhv_trips(spark, sf_dir).select(
        F.when(F.col("PULocationID") % 2 == 0, "HV0003").otherwise("HV0005").alias("hvfhs_license_num"),
        "dispatching_base_num", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID", "SR_Flag",
    )


class Service(NamedTuple):
    """How the files of one service are laid out."""

    trips: Callable[[SparkSession, str], DataFrame]
    landing: StructType
    lake: StructType
    prefix: str


SERVICES = {
    "yellow": Service(roles.yellow_trips, LANDING_YELLOW, YELLOW_TRIPS, "tpep"),
    "green": Service(roles.green_trips, LANDING_GREEN, GREEN_TRIPS, "lpep"),
}


def landing_rows(spark: SparkSession, sf_dir: str, service: str, by: str | None = None) -> DataFrame:
    """Trips in the order and naming of the landing files, codes as plain integers."""
    of = SERVICES[service]
    raw = of.trips(spark, sf_dir, by=by)
    for name in {"payment_type", "trip_type"} & set(raw.columns):
        raw = raw.withColumn(name, F.col(name).cast("double").cast("int"))
    return raw.select([field.name for field in of.landing])


def monthly_csv(spark: SparkSession, sf_dir: str, service: str) -> str:
    """Trips of a service as monthly CSV files named after their pickup month, the input of the loads."""
    inputs = roles.paths(sf_dir, *roles.TRIP_TABLES)
    return built_once(spark, ("monthly-csv", sf_dir, service), inputs, lambda: _write_monthly_csv(spark, sf_dir, service))


def _write_monthly_csv(spark: SparkSession, sf_dir: str, service: str) -> str:
    """The rows of a month are gathered in parts of Spark's advisory size, so that a compressed file stays one task's work."""
    month = F.date_format(f"{SERVICES[service].prefix}_pickup_datetime", "yyyy-MM")
    name = F.concat(F.lit(f"{service}_tripdata_"), month, F.lit(".csv"))
    rows = landing_rows(spark, sf_dir, service, by="date_trunc('MONTH', pickup_datetime)")
    return write_csv(rows.withColumn("file", name), "monthly", by="file", codec="gzip")


_HV_SQL = f"""WITH {checks.FHV} SELECT CASE WHEN pulocationid % 2 = 0 THEN 'HV0003' ELSE 'HV0005' END
    AS hvfhs_license_num, dispatching_base_num, pickup_datetime, dropoff_datetime,
    pulocationid AS "PULocationID", dolocationid AS "DOLocationID", sr_flag AS "SR_Flag" FROM fhv"""


@query(
    "scan_csv_untyped",
    f"""WITH typed AS ({_HV_SQL}) SELECT hvfhs_license_num, dispatching_base_num,
        strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_datetime,
        strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS dropoff_datetime,
        CAST("PULocationID" AS VARCHAR) AS "PULocationID", CAST("DOLocationID" AS VARCHAR) AS "DOLocationID",
        "SR_Flag" FROM typed""",
)
def scan_csv_untyped(spark, sf_dir):
    return files.read_csv(spark, write_csv(high_volume(spark, sf_dir), "csv"))


@query("scan_csv_typed", _HV_SQL)
def scan_csv_typed(spark, sf_dir):
    return files.read_csv(spark, write_csv(high_volume(spark, sf_dir), "csv"), HIGH_VOLUME_TRIPS)


@query("scan_csv_gzip", _HV_SQL)
def scan_csv_gzip(spark, sf_dir):
    path = write_csv(high_volume(spark, sf_dir), "csv-gz", codec="gzip")
    return files.spread(files.read_csv(spark, path, HIGH_VOLUME_TRIPS))


@query(
    "external_csv_ignore_unknown",
    f"""WITH {checks.FHV} SELECT dispatching_base_num, pulocationid AS "PULocationID",
        dolocationid AS "DOLocationID" FROM fhv""",
)
def external_csv_ignore_unknown(spark, sf_dir):
    raw = high_volume(spark, sf_dir).select(
        "dispatching_base_num", "PULocationID", "DOLocationID", "SR_Flag", "pickup_datetime"
    )
    declared = HIGH_VOLUME_TRIPS["dispatching_base_num"], HIGH_VOLUME_TRIPS["PULocationID"], HIGH_VOLUME_TRIPS["DOLocationID"]
    return files.read_csv(spark, write_csv(raw, "csv-wide"), type(HIGH_VOLUME_TRIPS)(list(declared)))


def _both_monthly(spark, sf_dir, **chosen) -> DataFrame:
    """Monthly files of both services, on the columns both have."""
    sides = [
        files.read_monthly(spark, monthly_csv(spark, sf_dir, service), of.landing, service, **chosen)
        for service, of in SERVICES.items()
    ]
    shared = common_columns(*sides)
    return sides[0].select(shared).unionByName(sides[1].select(shared))


@query(
    "scan_years_filter",
    f"""WITH {checks.TRIPS} SELECT lower(service) AS taxi_type, CAST(year(pickup_datetime) AS INTEGER) AS year,
        CAST(month(pickup_datetime) AS INTEGER) AS month, count(*) AS n_rows, {money('sum(total_amount)', 'total')}
        FROM trips WHERE year(pickup_datetime) IN (1996, 1998, 1999) GROUP BY 1, 2, 3""",
)
def scan_years_filter(spark, sf_dir):
    trips = _both_monthly(spark, sf_dir, years=[1996, 1998, 1999])
    counted = trips.groupBy("taxi_type", "year", "month").agg(F.count("*").alias("n_rows"), F.sum("total_amount").alias("total"))
    return as_double(counted, "total")


@query(
    "file_pattern_filter",
    f"""WITH {checks.TRIPS} SELECT lower(service) || strftime(pickup_datetime, '_tripdata_%Y-%m.csv') AS source_file,
        lower(service) AS taxi_type, CAST(year(pickup_datetime) AS INTEGER) AS year,
        CAST(month(pickup_datetime) AS INTEGER) AS month, count(*) AS n_rows FROM trips
        WHERE month(pickup_datetime) IN (1, 2) GROUP BY 1, 2, 3, 4""",
)
def file_pattern_filter(spark, sf_dir):
    trips = _both_monthly(spark, sf_dir, months=[1, 2])
    return trips.groupBy("source_file", "taxi_type", "year", "month").agg(F.count("*").alias("n_rows"))


def _ingested_sql(service: str) -> str:
    return f"""WITH {checks.TRIPS} SELECT CAST(year(pickup_datetime) AS INTEGER) AS year,
        CAST(month(pickup_datetime) AS INTEGER) AS month, vendorid AS "VendorID", count(*) AS n_rows,
        {money('sum(total_amount)', 'total')} FROM trips WHERE service = '{service}' GROUP BY 1, 2, 3"""


def _ingested(spark, sf_dir, service: str) -> DataFrame:
    lake = loads.ingest_months(
        spark, monthly_csv(spark, sf_dir, service), new_dir(spark, "lake"), SERVICES[service].lake, service
    )
    # Doubles from the files are summed as exact decimals.
    counted = lake.groupBy("year", "month", "VendorID").agg(
        F.count("*").alias("n_rows"), F.sum(numeric(F.col("total_amount"))).alias("total")
    )
    return as_double(counted, "total")


@query("ingest_all_months", _ingested_sql("Yellow"))
def ingest_all_months(spark, sf_dir):
    return _ingested(spark, sf_dir, "yellow")


@query("ingest_green_months", _ingested_sql("Green"))
def ingest_green_months(spark, sf_dir):
    return _ingested(spark, sf_dir, "green")


_HASH_7 = """md5(coalesce(CAST(vendorid AS VARCHAR), '') || CAST(pickup_datetime AS VARCHAR)
    || CAST(dropoff_datetime AS VARCHAR) || CAST(pulocationid AS VARCHAR) || CAST(dolocationid AS VARCHAR)
    || CAST(CAST(fare_amount AS DECIMAL(38,9)) AS VARCHAR)
    || CAST(CAST(trip_distance AS DECIMAL(38,9)) AS VARCHAR))"""


_HASH_5 = """unhex(md5(coalesce(CAST(vendorid AS VARCHAR), '') || CAST(pickup_datetime AS VARCHAR)
    || CAST(dropoff_datetime AS VARCHAR) || CAST(pulocationid AS VARCHAR) || CAST(dolocationid AS VARCHAR)))"""


def _loaded_sql(service: str, identity: str) -> str:
    prefix = SERVICES[service].prefix
    return f"""WITH {checks.TRIPS} SELECT {identity} AS unique_row_id,
        strftime(pickup_datetime, '{service}_tripdata_%Y-%m.csv') AS filename, vendorid::VARCHAR AS "VendorID",
        pickup_datetime AS {prefix}_pickup_datetime, CAST(CAST(payment_type AS DOUBLE) AS INTEGER) AS payment_type,
        {money('total_amount')} FROM trips WHERE service = '{service.title()}'"""


def _loaded(spark, sf_dir, service: str, warehouse: bool = False) -> DataFrame:
    """All months are loaded, then the first quarter of every year once more, which adds nothing."""
    of, root, path = SERVICES[service], monthly_csv(spark, sf_dir, service), new_dir(spark, "landing")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    for months in ((), (1, 2, 3)):
        loads.load_month(
            spark, table, files.monthly_glob(root, service, months=months), of.landing,
            f"{of.prefix}_pickup_datetime", f"{of.prefix}_dropoff_datetime", warehouse, path,
        )
    rows = detached(spark, table, path)
    return as_double(
        rows.select("unique_row_id", "filename", "VendorID", f"{of.prefix}_pickup_datetime", "payment_type", "total_amount"),
        "total_amount",
    )


def detached(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The rows of an external table whose name is given up."""
    schema = spark.table(table).schema
    drop_table(spark, table)
    return spark.read.schema(schema).parquet(path)


@query("elt_month", _loaded_sql("yellow", _HASH_7))
def elt_month(spark, sf_dir):
    return _loaded(spark, sf_dir, "yellow")


@query("elt_month_green", _loaded_sql("green", _HASH_7))
def elt_month_green(spark, sf_dir):
    return _loaded(spark, sf_dir, "green")


@query(
    "elt_month_warehouse",
    " UNION ALL ".join(
        f"SELECT unique_row_id, filename, VendorID, {SERVICES[service].prefix}_pickup_datetime AS pickup_datetime, payment_type, total_amount "
        f"FROM ({_loaded_sql(service, _HASH_5)})" for service in SERVICES
    ),
)
def elt_month_warehouse(spark, sf_dir):
    """The warehouse form of both services' loads: a binary hash of five columns."""
    sides = [
        _loaded(spark, sf_dir, service, warehouse=True).withColumnRenamed(f"{of.prefix}_pickup_datetime", "pickup_datetime")
        for service, of in SERVICES.items()
    ]
    return sides[0].unionByName(sides[1])


@query(
    "count_by_filename",
    f"""WITH {checks.TRIPS}, named AS (SELECT strftime(pickup_datetime, 'yellow_tripdata_%Y-%m.csv') AS filename
        FROM trips WHERE service = 'Yellow')
        SELECT count_if(regexp_matches(filename, 'yellow_tripdata_1998-\\d{{2}}\\.csv')) AS rows_1998,
               count_if(filename LIKE 'yellow_tripdata_1999-03%') AS rows_1999_03 FROM named""",
)
def count_by_filename(spark, sf_dir):
    landed = files.read_csv(spark, files.monthly_glob(monthly_csv(spark, sf_dir, "yellow"), "yellow"), LANDING_YELLOW)
    named = landed.select(files.file_name().alias("filename"))
    return named.agg(
        F.count_if(F.col("filename").rlike(r"yellow_tripdata_1998-\d{2}\.csv")).alias("rows_1998"),
        F.count_if(F.col("filename").like("yellow_tripdata_1999-03%")).alias("rows_1999_03"),
    )


@query(
    "external_table_scan",
    "SELECT o_orderstatus, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
)
def external_table_scan(spark, sf_dir):
    sibling = spark.newSession()
    files.external_view(sibling, "external_orders", f"{sf_dir}/orders.parquet")
    return sibling.sql(
        """SELECT o_orderstatus, count(*) AS n_rows,
                  CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
           FROM external_orders GROUP BY o_orderstatus"""
    )


@query("ctas_copy", "SELECT * FROM orders")
def ctas_copy(spark, sf_dir):
    path = new_dir(spark, "copy")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    roles.table(spark, sf_dir, "orders").write.option("path", path).saveAsTable(name)
    return detached(spark, name, path)


@query(
    "append_years",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_rows FROM orders GROUP BY 1",
)
def append_years(spark, sf_dir):
    orders = roles.table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    path = new_dir(spark, "years")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    orders.filter(early).write.option("path", path).saveAsTable(name)
    append_rows(orders.filter(~early), name)
    return detached(spark, name, path).groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n_rows"))


@query(
    "json_products_avg",
    "SELECT p_brand AS brand, round(avg(p_retailprice), 2) AS avg_price FROM part GROUP BY 1",
)
def json_products_avg(spark, sf_dir):
    part = roles.table(spark, sf_dir, "part")
    path = new_dir(spark, "products")
    product = F.struct(F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price"))
    # Up to fifty products per document.
    documents = part.groupBy(F.floor(F.col("p_partkey") / 50).alias("page")).agg(F.collect_list(product).alias("products"))
    documents.select("products").write.json(path)
    products = files.read_products(spark, path, PRODUCTS_DOCUMENT)
    exact = products.withColumn("price", F.col("price").cast("decimal(12,2)"))
    averages = average_rounded(exact, "brand", "price", "avg_price")
    return as_double(averages, "avg_price").orderBy(F.col("avg_price").desc(), "brand")


@query(
    "project_with_default",
    """SELECT p_brand AS brand, CAST(p_retailprice AS VARCHAR) AS price, 'N/A' AS warranty FROM part""",
)
def project_with_default(spark, sf_dir):
    part = roles.table(spark, sf_dir, "part").withColumnsRenamed({"p_brand": "brand", "p_retailprice": "price"})
    return with_default_columns(part, ["brand", "price", "warranty"])


def trip_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Green-style trip messages of all trips; times are text, as the producer sends them."""
    trips = roles.trips(spark, sf_dir).select(
        F.date_format("pickup_datetime", files.CSV_TIME_FORMAT).alias("lpep_pickup_datetime"),
        F.date_format("dropoff_datetime", files.CSV_TIME_FORMAT).alias("lpep_dropoff_datetime"),
        F.col("pulocationid").alias("PULocationID"),
        F.col("dolocationid").alias("DOLocationID"),
        F.col("passenger_count").cast("double").alias("passenger_count"),
        "trip_distance",
        F.col("tip_amount").cast("double").alias("tip_amount"),
    )
    return to_messages(trips, TRIP_MESSAGE_COLUMNS)


@query(
    "to_json_messages",
    f"""WITH {checks.TRIPS} SELECT CAST(to_json({{'lpep_pickup_datetime': CAST(pickup_datetime AS VARCHAR),
        'lpep_dropoff_datetime': CAST(dropoff_datetime AS VARCHAR), 'PULocationID': pulocationid,
        'DOLocationID': dolocationid, 'passenger_count': CAST(passenger_count AS DOUBLE),
        'trip_distance': trip_distance, {money('tip_amount').rsplit(' AS ', 1)[0].join(["'tip_amount': ", ''])}}})
        AS VARCHAR) AS value FROM trips""",
)
def to_json_messages(spark, sf_dir):
    return trip_messages(spark, sf_dir)


_LINEITEM_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}


@query(
    "describe_schema",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{dtype}' AS data_type, count({name}) AS non_null_rows FROM lineitem"
        for name, dtype in _LINEITEM_TYPES.items()
    ),
)
def describe_schema(spark, sf_dir):
    return files.column_summary(roles.table(spark, sf_dir, "lineitem"))


_LISTED = sorted(TABLES)


@query(
    "list_tables",
    " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {name}" for name in _LISTED),
)
def list_tables(spark, sf_dir):
    sibling = spark.newSession()
    for name in _LISTED:
        roles.table(sibling, sf_dir, name).createOrReplaceTempView(name)
    return files.table_list(sibling, _LISTED)


@query("parquet_roundtrip", "SELECT * FROM lineitem")
def parquet_roundtrip(spark, sf_dir):
    path = new_dir(spark, "roundtrip")
    orders = roles.table(spark, sf_dir, "lineitem")
    halves = F.col("l_linestatus") == "O"
    layout.write_parquet(orders.filter(halves), path, "overwrite")
    layout.write_parquet(orders.filter(~halves), path, "append")
    layout.write_parquet(orders, path, "ignore")
    return spark.read.parquet(path)


def _written_in_files(rows: DataFrame, files_wanted: int) -> DataFrame:
    """Files and rows of a repartitioned write, and whether the files have a mean size."""
    path = new_dir(rows.sparkSession, "files")
    layout.write_in_files(rows, path, files_wanted)
    stored = rows.sparkSession.read.parquet(path).agg(F.count("*").alias("n_rows"))
    return layout.file_sizes(rows.sparkSession, path).select(
        "files", stored.scalar().alias("n_rows"), (F.col("avg_megabytes") > 0).alias("has_size"))


@query("repartition_write", "SELECT 24::BIGINT AS files, count(*) AS n_rows, true AS has_size FROM lineitem")
def repartition_write(spark, sf_dir):
    return _written_in_files(roles.table(spark, sf_dir, "lineitem"), 24)


@query(
    "avg_file_size",
    f"WITH {checks.TRIPS} SELECT 4::BIGINT AS files, count(*) AS n_rows, true AS has_size FROM trips WHERE service = 'Yellow'",
)
def avg_file_size(spark, sf_dir):
    return _written_in_files(roles.yellow_trips(spark, sf_dir), 4)


@query(
    "partitioned_write_read",
    f"""WITH {checks.TRIPS} SELECT CAST(year(pickup_datetime) AS INTEGER) AS year,
        CAST(month(pickup_datetime) AS INTEGER) AS month, vendorid, passenger_count, {money('total_amount')}
        FROM trips""",
)
def partitioned_write_read(spark, sf_dir):
    path = new_dir(spark, "by-month")
    trips = roles.trips(spark, sf_dir).select(
        F.year("pickup_datetime").alias("year"), F.month("pickup_datetime").alias("month"),
        "vendorid", "passenger_count", "total_amount",
    )
    layout.write_partitioned(trips, path, ["year", "month"])
    return as_double(spark.read.parquet(path), "total_amount")


def by_dropoff_date(spark: SparkSession, sf_dir: str, cluster_by: tuple[str, ...] = ()) -> DataFrame:
    """Yellow trips stored by drop-off date; one stored table serves all its readers."""
    return spark.read.parquet(dropoff_date_path(spark, sf_dir, cluster_by))


def dropoff_date_path(spark: SparkSession, sf_dir: str, cluster_by: tuple[str, ...] = ()) -> str:
    def write() -> str:
        path = new_dir(spark, "by-date")
        trips = roles.yellow_trips(spark, sf_dir).select(
            "vendorid", "tpep_dropoff_datetime", "pulocationid", "total_amount"
        )
        layout.write_by_date(trips, path, "tpep_dropoff_datetime", "dropoff_date", cluster_by=cluster_by)
        return path

    inputs = roles.paths(sf_dir, *roles.TRIP_TABLES)
    return built_once(spark, ("by-date", sf_dir, *cluster_by), inputs, write)


@query(
    "partition_pruned_distinct",
    f"""WITH {checks.TRIPS} SELECT DISTINCT vendorid FROM trips WHERE service = 'Yellow'
        AND CAST(dropoff_datetime AS DATE) BETWEEN DATE '1998-03-01' AND DATE '1998-03-15'""",
)
def partition_pruned_distinct(spark, sf_dir):
    stored = by_dropoff_date(spark, sf_dir)
    return stored.filter(F.col("dropoff_date").between("1998-03-01", "1998-03-15")).select("vendorid").distinct()


@query(
    "clustered_count",
    f"""WITH {checks.TRIPS} SELECT count(*) AS trips FROM trips WHERE service = 'Yellow' AND vendorid = 1
        AND CAST(dropoff_datetime AS DATE) BETWEEN DATE '1998-06-01' AND DATE '1998-12-30'""",
)
def clustered_count(spark, sf_dir):
    stored = by_dropoff_date(spark, sf_dir, cluster_by=("vendorid",))
    return stored.filter(
        F.col("dropoff_date").between("1998-06-01", "1998-12-30") & (F.col("vendorid") == 1)
    ).agg(F.count("*").alias("trips"))


@query(
    "partition_row_counts",
    f"""WITH {checks.TRIPS} SELECT CAST(dropoff_datetime AS DATE) AS partition_id, count(*) AS total_rows
        FROM trips WHERE service = 'Yellow' GROUP BY 1""",
)
def partition_row_counts(spark, sf_dir):
    return layout.partition_row_counts(by_dropoff_date(spark, sf_dir), "dropoff_date")
