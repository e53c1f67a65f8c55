"""Facts and marts over the staging models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from meterline.functions.temporal import elapsed_seconds, month_start
from meterline.functions.text import year_quarter
from meterline.operators.dimensions import known_zones, with_both_zones
from meterline.operators.joins import join_null_safe
from meterline.operators.percentiles import exact_percentiles
from meterline.operators.windows import at_dense_rank
from meterline.workspace import materialize

# The columns of the trip facts, and the summed money columns.
FACT_COLUMNS = [
    "tripid", "vendorid", "service_type", "ratecodeid",
    "pickup_locationid", "pickup_borough", "pickup_zone",
    "dropoff_locationid", "dropoff_borough", "dropoff_zone",
    "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count",
    "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount",
    "payment_type", "payment_type_description",
]
REVENUE_PARTS = [
    "fare", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
    "improvement_surcharge", "total_amount",
]
# The payment labels the fare percentiles are meant to cover. The spelling
# ``Credit Card`` would match no row, as the label reads ``Credit card``.
FARE_PAYMENTS = ("Cash", "Credit card")


def fact_trips(green: DataFrame, yellow: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips of both services between known zones, 26 columns."""
    return fact_staged(green.withColumn("service_type", F.lit("Green")).unionByName(
        yellow.withColumn("service_type", F.lit("Yellow"))
    ), zones)


def fact_staged(staged: DataFrame, zones: DataFrame) -> DataFrame:
    """The same facts from staged trips that carry their ``service_type``."""
    return with_both_zones(staged, known_zones(zones)).select(FACT_COLUMNS)


def fact_fhv_trips(staged: DataFrame, zones: DataFrame) -> DataFrame:
    """For-hire trips between known zones, with year and month of pickup."""
    dated = staged.withColumns(
        {
            "service_type": F.lit("Fhv"),
            "year": F.year("pickup_datetime"),
            "month": F.month("pickup_datetime"),
        }
    )
    return with_both_zones(dated, known_zones(zones)).select(
        "dispatching_base_num", "service_type",
        "pickup_locationid", "pickup_borough", "pickup_zone",
        "dropoff_locationid", "dropoff_borough", "dropoff_zone",
        "pickup_datetime", "dropoff_datetime", "sr_flag", "year", "month",
    )


def fhv_travel_times(facts: DataFrame) -> DataFrame:
    """Duration of every for-hire trip, in whole seconds.

    The facts already hold zone names, so the zones are not joined again.
    """
    return facts.select(
        "dispatching_base_num", "year", "month", "pickup_zone", "dropoff_zone",
        elapsed_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime")).alias("trip_duration"),
        "dropoff_locationid", "pickup_locationid", "service_type",
    )


def _revenue_measures() -> list[Column]:
    source = {"fare": "fare_amount"}
    sums = [
        F.sum(source.get(part, part)).alias(f"revenue_monthly_{part}") for part in REVENUE_PARTS
    ]
    return [
        *sums,
        F.count("tripid").alias("total_monthly_trips"),
        F.avg("passenger_count").alias("avg_monthly_passenger_count"),
        F.avg("trip_distance").alias("avg_monthly_trip_distance"),
    ]


def monthly_zone_revenue(facts: DataFrame) -> DataFrame:
    """Revenue per pickup zone, month and service."""
    return facts.groupBy(
        F.col("pickup_zone").alias("revenue_zone"),
        month_start(F.col("pickup_datetime")).alias("revenue_month"),
        "service_type",
    ).agg(*_revenue_measures())


def quarterly_revenue(facts: DataFrame) -> DataFrame:
    """Revenue per zone, quarter, month number and service.

    The grain is the month, as the column names say; consumers add up quarters.
    """
    ts = F.col("pickup_datetime")
    return facts.groupBy(
        F.col("pickup_zone").alias("revenue_zone"),
        F.year(ts).alias("revenue_year"),
        F.quarter(ts).alias("revenue_quarter"),
        year_quarter(ts).alias("revenue_year_quarter"),
        F.month(ts).alias("revenue_month_number"),
        "service_type",
    ).agg(*_revenue_measures())


def quarterly_totals(quarterly: DataFrame) -> DataFrame:
    """Total revenue per year, quarter and service."""
    return quarterly.groupBy("revenue_year", "revenue_quarter", "service_type").agg(
        F.sum("revenue_monthly_total_amount").alias("total_revenue")
    )


def yoy_growth(totals: DataFrame) -> DataFrame:
    """Growth in percent against the same quarter of the year before.

    A missing prior year counts as 0 in the difference and as 1 in the divisor.
    """
    keys = ["revenue_year", "revenue_quarter", "service_type"]
    prior = totals.select(
        (F.col("revenue_year") + 1).alias("revenue_year"), "revenue_quarter", "service_type",
        F.col("total_revenue").alias("_prior"),
    )
    known = F.coalesce(F.col("_prior"), F.lit(0))
    growth = F.try_divide(
        (F.col("total_revenue") - known).cast("double"),
        F.coalesce(F.col("_prior"), F.lit(1)).cast("double"),
    )
    return totals.join(prior, keys, "left").select(
        *keys,
        F.col("total_revenue").alias("current_year_revenue"),
        known.alias("previous_year_revenue"),
        (growth * 100).alias("yoy_growth_percentage"),
    )


def _paying_trips(facts: DataFrame, payments: Sequence[str]) -> DataFrame:
    return facts.filter(
        (F.col("fare_amount") > 0)
        & (F.col("trip_distance") > 0)
        & F.col("payment_type_description").isin(*payments)
    )


def fare_percentiles(
    facts: DataFrame, probabilities: Sequence[float] = (0.97, 0.95, 0.90),
    payments: Sequence[str] = FARE_PAYMENTS,
) -> DataFrame:
    """Exact fare percentiles per service, year and month, one row per group."""
    paying = _paying_trips(facts, payments).select(
        "service_type",
        F.year("pickup_datetime").alias("year"),
        F.month("pickup_datetime").alias("month"),
        F.col("fare_amount").cast("double").alias("fare"),
    )
    names = [f"p{round(p * 100)}_fare" for p in probabilities]
    return exact_percentiles(paying, ["service_type", "year", "month"], "fare", dict(zip(names, probabilities)))


def fare_p95_rows(facts: DataFrame, payments: Sequence[str] = FARE_PAYMENTS) -> DataFrame:
    """The 95th fare percentile of its service and month, on every paying trip.

    The percentile is computed once per group and joined back, instead of
    sorting all trips of a group in one window partition. The few percentile rows
    are stored first: the join is then planned with their true size, and the trips
    are not shuffled for it.
    """
    ts = F.col("pickup_datetime")
    paying = _paying_trips(facts, payments).select(
        F.col("pickup_zone").alias("revenue_zone"),
        F.year(ts).alias("revenue_year"),
        F.month(ts).alias("revenue_month"),
        F.quarter(ts).alias("revenue_quarter"),
        year_quarter(ts).alias("revenue_year_quarter"),
        "service_type",
        F.col("fare_amount").cast("double").alias("fare"),
    )
    keys = ["service_type", "revenue_year", "revenue_month"]
    p95 = materialize(exact_percentiles(paying, keys, "fare", {"fare_amount_p95": 0.95}), "fare-p95")
    return join_null_safe(paying.drop("fare"), p95, keys)


def second_longest_p90(
    travel_times: DataFrame, year: int, month: int, pickup_zones: Sequence[str], distinct: bool = True,
) -> DataFrame:
    """Drop-off zone with the second longest p90 duration, per pickup zone.

    ``distinct=False`` repeats each answer once per trip of its zone pair.
    """
    chosen = travel_times.filter(
        (F.col("year") == year) & (F.col("month") == month) & F.col("pickup_zone").isin(*pickup_zones)
    )
    pair = ["pickup_locationid", "pickup_zone", "dropoff_locationid", "dropoff_zone"]
    p90 = exact_percentiles(chosen, pair, "trip_duration", {"p90_duration": 0.9})
    answer = at_dense_rank(p90, ["pickup_zone"], F.col("p90_duration").desc(), 2)
    if not distinct:
        answer = join_null_safe(chosen.select(pair), answer, pair)
    return answer.select(
        "pickup_zone",
        F.col("dropoff_zone").alias("second_longest_p90_dropoff_zone"),
        F.col("p90_duration").alias("p90_trip_duration_seconds"),
    )
