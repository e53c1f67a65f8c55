"""Staging models, facts and marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.operators.dimensions import zone_dimension
from meterline.operators.windows import keep_first
from meterline.plans import marts, staging
from meterline.registry import checks
from meterline.registry.book import query
from meterline.registry.checks import money, moneys
from meterline.schemas import ZONES
from meterline.sources import roles
from meterline.workspace import built_once, materialize, new_dir

FHV_YEAR = 1999
PICKUP_ZONES = ("NATION_1", "NATION_7", "NATION_12")


def as_double(df: DataFrame, *names: str) -> DataFrame:
    """Money columns as doubles, the form results are compared in."""
    return df.withColumns({name: F.col(name).cast("double") for name in names})


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name).cast("double"), 6) for name in names})


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone dimension as a stored table, whose file size tells Spark that it is small."""

    def write() -> str:
        path = new_dir(spark, "dim-zones")
        zone_dimension(roles.zone_seed(spark, sf_dir)).write.parquet(path)
        return path

    return spark.read.schema(ZONES).parquet(built_once(spark, ("dim-zones", sf_dir), roles.paths(sf_dir, "nation", "region"), write))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of both services; the trips are derived once."""
    return marts.fact_staged(staging.stage_services(roles.trips(spark, sf_dir)), zones(spark, sf_dir))


def fhv_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = date(FHV_YEAR, 1, 1), date(FHV_YEAR + 1, 1, 1)
    return staging.stage_fhv(roles.fhv_trips(spark, sf_dir, *year), FHV_YEAR)


def fhv_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fact_fhv_trips(fhv_staged(spark, sf_dir), zones(spark, sf_dir))


@query("dim_zones", f"WITH {checks.ZONES} SELECT * FROM dim_zones")
def dim_zones(spark, sf_dir):
    return zone_dimension(roles.zone_seed(spark, sf_dir))


_STG_DOUBLES = ["trip_distance", *staging.MONEY]
_STG_SQL = (
    "SELECT tripid, vendorid, ratecodeid, pickup_locationid, dropoff_locationid, pickup_datetime, "
    "dropoff_datetime, store_and_fwd_flag, passenger_count, trip_type, payment_type, "
    f"payment_type_description, {moneys(*_STG_DOUBLES)} FROM "
)


@query("stg_green", f"WITH {checks.TRIPS}, {checks.STG_GREEN} {_STG_SQL} stg_green")
def stg_green(spark, sf_dir):
    return as_double(staging.stage_green(roles.green_trips(spark, sf_dir)), *_STG_DOUBLES)


@query("stg_yellow", f"WITH {checks.TRIPS}, {checks.STG_YELLOW} {_STG_SQL} stg_yellow")
def stg_yellow(spark, sf_dir):
    return as_double(staging.stage_yellow(roles.yellow_trips(spark, sf_dir)), *_STG_DOUBLES)


@query("stg_fhv", f"WITH {checks.FHV} SELECT * FROM stg_fhv")
def stg_fhv(spark, sf_dir):
    return fhv_staged(spark, sf_dir)


@query(
    "dedup_trips",
    f"""WITH {checks.TRIPS} SELECT service, vendorid, pickup_datetime, dropoff_datetime, pulocationid,
        dolocationid, passenger_count, {money('total_amount')}
        FROM (SELECT *, row_number() OVER (PARTITION BY service, vendorid, pickup_datetime
              ORDER BY dropoff_datetime, pulocationid, dolocationid, passenger_count, total_amount) AS rn
              FROM trips WHERE vendorid IS NOT NULL) WHERE rn = 1""",
)
def dedup_trips(spark, sf_dir):
    narrow = roles.trips(spark, sf_dir).filter("vendorid IS NOT NULL").select(
        "service", "vendorid", "pickup_datetime", "dropoff_datetime", "pulocationid", "dolocationid",
        "passenger_count", "total_amount",
    )
    return as_double(keep_first(narrow, ["pickup_datetime", "vendorid", "service"]), "total_amount")


@query(
    "fact_trips",
    f"""WITH {checks.FACTS} SELECT tripid, vendorid, service_type, ratecodeid, pickup_locationid,
        pickup_borough, pickup_zone, dropoff_locationid, dropoff_borough, dropoff_zone, pickup_datetime,
        dropoff_datetime, store_and_fwd_flag, passenger_count, trip_type, payment_type,
        payment_type_description, {moneys(*_STG_DOUBLES)} FROM fact_trips""",
)
def fact_trips(spark, sf_dir):
    return as_double(facts(spark, sf_dir), *_STG_DOUBLES)


@query(
    "fact_fhv_trips",
    f"""WITH {checks.FHV} SELECT dispatching_base_num, service_type, pickup_locationid, pickup_borough,
        pickup_zone, dropoff_locationid, dropoff_borough, dropoff_zone, pickup_datetime, dropoff_datetime,
        sr_flag, year, month FROM fact_fhv""",
)
def fact_fhv_trips(spark, sf_dir):
    return fhv_facts(spark, sf_dir)


@query("fhv_trip_duration", f"WITH {checks.FHV} SELECT * FROM travel")
def fhv_trip_duration(spark, sf_dir):
    return marts.fhv_travel_times(fhv_facts(spark, sf_dir))


_MEASURES = [f"revenue_monthly_{part}" for part in marts.REVENUE_PARTS]
_MEASURE_SQL = ", ".join(
    [
        money(f"sum({'fare_amount' if part == 'fare' else part})", f"revenue_monthly_{part}")
        for part in marts.REVENUE_PARTS
    ]
    + [
        "count(tripid) AS total_monthly_trips",
        "round(avg(CAST(passenger_count AS DOUBLE)), 6) AS avg_monthly_passenger_count",
        "round(avg(CAST(trip_distance AS DOUBLE)), 6) AS avg_monthly_trip_distance",
    ]
)
_AVERAGES = ["avg_monthly_passenger_count", "avg_monthly_trip_distance"]


@query(
    "monthly_zone_revenue",
    f"""WITH {checks.FACTS} SELECT pickup_zone AS revenue_zone,
        date_trunc('month', pickup_datetime)::TIMESTAMP AS revenue_month, service_type, {_MEASURE_SQL}
        FROM fact_trips GROUP BY 1, 2, 3""",
)
def monthly_zone_revenue(spark, sf_dir):
    return rounded(as_double(marts.monthly_zone_revenue(facts(spark, sf_dir)), *_MEASURES), *_AVERAGES)


_QUARTER_KEYS = """CAST(year(pickup_datetime) AS INTEGER) AS revenue_year,
        CAST(quarter(pickup_datetime) AS INTEGER) AS revenue_quarter"""


@query(
    "quarterly_revenue",
    f"""WITH {checks.FACTS} SELECT pickup_zone AS revenue_zone, {_QUARTER_KEYS},
        year(pickup_datetime) || '/Q' || quarter(pickup_datetime) AS revenue_year_quarter,
        CAST(month(pickup_datetime) AS INTEGER) AS revenue_month_number, service_type, {_MEASURE_SQL}
        FROM fact_trips GROUP BY 1, 2, 3, 4, 5, 6""",
)
def quarterly_revenue(spark, sf_dir):
    return rounded(as_double(marts.quarterly_revenue(facts(spark, sf_dir)), *_MEASURES), *_AVERAGES)


_TOTALS = f"""{checks.FACTS}, totals AS (
  SELECT {_QUARTER_KEYS}, service_type, sum(total_amount) AS total_revenue FROM fact_trips GROUP BY 1, 2, 3)"""


def _totals(spark, sf_dir) -> DataFrame:
    return marts.quarterly_totals(marts.quarterly_revenue(facts(spark, sf_dir)))


@query(
    "quarterly_totals",
    f"""WITH {_TOTALS} SELECT revenue_year, revenue_quarter, service_type, {money('total_revenue')} FROM totals""",
)
def quarterly_totals(spark, sf_dir):
    return as_double(_totals(spark, sf_dir), "total_revenue")


@query(
    "yoy_growth",
    f"""WITH {_TOTALS} SELECT c.revenue_year, c.revenue_quarter, c.service_type,
        {money('c.total_revenue', 'current_year_revenue')},
        {money('coalesce(p.total_revenue, 0)', 'previous_year_revenue')},
        round(CAST(c.total_revenue - coalesce(p.total_revenue, 0) AS DOUBLE)
              / nullif(CAST(coalesce(p.total_revenue, 1) AS DOUBLE), 0) * 100, 2) AS yoy_growth_percentage
        FROM totals c LEFT JOIN totals p ON c.revenue_year = p.revenue_year + 1
             AND c.revenue_quarter = p.revenue_quarter AND c.service_type = p.service_type""",
)
def yoy_growth(spark, sf_dir):
    # The totals are a few rows read twice: written once, the facts are built once.
    growth = marts.yoy_growth(materialize(_totals(spark, sf_dir), "quarterly-totals"))
    amounts = as_double(growth, "current_year_revenue", "previous_year_revenue")
    return amounts.withColumn("yoy_growth_percentage", F.round("yoy_growth_percentage", 2))


_PAYING = f"""{checks.FACTS}, paying AS (
  SELECT *, CAST(year(pickup_datetime) AS INTEGER) AS y, CAST(month(pickup_datetime) AS INTEGER) AS m,
         CAST(quarter(pickup_datetime) AS INTEGER) AS q, CAST(fare_amount AS DOUBLE) AS fare
  FROM fact_trips WHERE fare_amount > 0 AND trip_distance > 0
       AND payment_type_description IN ('Cash', 'Credit card'))"""


def stored_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact columns fare marts read, stored once, as they are read more than once."""
    columns = [
        "service_type", "pickup_zone", "pickup_datetime", "fare_amount", "trip_distance",
        "payment_type_description",
    ]
    return materialize(facts(spark, sf_dir).select(columns), "fares")


@query(
    "fare_p95_rows",
    f"""WITH {_PAYING} SELECT pickup_zone AS revenue_zone, y AS revenue_year, m AS revenue_month,
        q AS revenue_quarter, y || '/Q' || q AS revenue_year_quarter, service_type,
        round(quantile_cont(fare, 0.95) OVER (PARTITION BY service_type, y, m), 6) AS fare_amount_p95
        FROM paying""",
)
def fare_p95_rows(spark, sf_dir):
    return rounded(marts.fare_p95_rows(stored_fares(spark, sf_dir)), "fare_amount_p95")


@query(
    "fare_percentiles",
    f"""WITH {_PAYING} SELECT service_type, y AS year, m AS month,
        round(quantile_cont(fare, 0.97), 6) AS p97_fare, round(quantile_cont(fare, 0.95), 6) AS p95_fare,
        round(quantile_cont(fare, 0.90), 6) AS p90_fare FROM paying GROUP BY 1, 2, 3""",
)
def fare_percentiles(spark, sf_dir):
    return rounded(marts.fare_percentiles(facts(spark, sf_dir)), "p97_fare", "p95_fare", "p90_fare")


@query(
    "second_longest_p90",
    f"""WITH {checks.FHV}, p90 AS (
          SELECT pickup_zone, dropoff_zone, quantile_cont(CAST(trip_duration AS DOUBLE), 0.9) AS p90
          FROM travel WHERE year = {FHV_YEAR} AND month = 11 AND pickup_zone IN {PICKUP_ZONES}
          GROUP BY pickup_locationid, pickup_zone, dropoff_locationid, dropoff_zone),
        ranked AS (SELECT *, dense_rank() OVER (PARTITION BY pickup_zone ORDER BY p90 DESC) AS r FROM p90)
        SELECT pickup_zone, dropoff_zone AS second_longest_p90_dropoff_zone,
               round(p90, 6) AS p90_trip_duration_seconds FROM ranked WHERE r = 2""",
)
def second_longest_p90(spark, sf_dir):
    travel = marts.fhv_travel_times(fhv_facts(spark, sf_dir))
    return rounded(
        marts.second_longest_p90(travel, FHV_YEAR, 11, PICKUP_ZONES), "p90_trip_duration_seconds"
    )
