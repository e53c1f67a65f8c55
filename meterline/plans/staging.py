"""Staging models: one row per vendor and pickup time, typed and decoded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from meterline.functions.casts import int_via_double, numeric, safe_int
from meterline.functions.decode import payment_type_description
from meterline.functions.keys import surrogate_key
from meterline.operators.windows import keep_first

# The money columns of a staged trip.
MONEY = [
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
    "improvement_surcharge", "total_amount",
]


def _staged(
    raw: DataFrame, pickup: str, dropoff: str, trip_type: Column, ehail_fee: Column,
    payment_type: Column,
) -> DataFrame:
    # The pickup time comes first, as rows are sorted by it: few trips share it.
    kept = keep_first(raw.filter(F.col("vendorid").isNotNull()), [pickup, "vendorid"])
    return _typed(kept, raw, pickup, dropoff, trip_type, ehail_fee, payment_type)


def _typed(
    kept: DataFrame, raw: DataFrame, pickup: str, dropoff: str, trip_type: Column, ehail_fee: Column,
    payment_type: Column, more: Sequence[Column] = (),
) -> DataFrame:
    money = {name: ehail_fee if name == "ehail_fee" else F.col(name) for name in MONEY}
    return kept.select(
        surrogate_key(F.col("vendorid"), F.col(pickup)).alias("tripid"),
        _plain_int(raw, "vendorid").alias("vendorid"),
        _float_int(raw, "ratecodeid").alias("ratecodeid"),
        _plain_int(raw, "pulocationid").alias("pickup_locationid"),
        _plain_int(raw, "dolocationid").alias("dropoff_locationid"),
        F.col(pickup).cast("timestamp").alias("pickup_datetime"),
        F.col(dropoff).cast("timestamp").alias("dropoff_datetime"),
        "store_and_fwd_flag",
        _plain_int(raw, "passenger_count").alias("passenger_count"),
        numeric(F.col("trip_distance")).alias("trip_distance"),
        trip_type.alias("trip_type"),
        *[numeric(column).alias(name) for name, column in money.items()],
        F.coalesce(payment_type, F.lit(0)).alias("payment_type"),
        payment_type_description(F.col("payment_type"), _is_text(raw, "payment_type")).alias(
            "payment_type_description"
        ),
        *more,
    )


def _is_text(raw: DataFrame, name: str) -> bool:
    types = {column.lower(): dtype for column, dtype in raw.dtypes}
    return types[name.lower()] == "string"


def _plain_int(raw: DataFrame, name: str) -> Column:
    return safe_int(F.col(name), _is_text(raw, name))


def _float_int(raw: DataFrame, name: str) -> Column:
    return int_via_double(F.col(name), _is_text(raw, name))


def stage_green(raw: DataFrame) -> DataFrame:
    """Green trips; codes may arrive as float-looking text."""
    return _staged(
        raw, "lpep_pickup_datetime", "lpep_dropoff_datetime",
        trip_type=_float_int(raw, "trip_type"),
        ehail_fee=F.col("ehail_fee"),
        payment_type=_float_int(raw, "payment_type"),
    )


def stage_yellow(raw: DataFrame) -> DataFrame:
    """Yellow trips: always street hails without an e-hail fee.

    The payment code takes a plain safe cast, so ``'1.0'`` becomes 0 while its
    label still reads ``Credit card``.
    """
    return _staged(
        raw, "tpep_pickup_datetime", "tpep_dropoff_datetime",
        trip_type=F.lit(1),
        ehail_fee=F.lit(0),
        payment_type=_plain_int(raw, "payment_type"),
    )


# Order in which rows of one vendor and pickup time are preferred, per service: the order of its files' columns.
GREEN_PREFERENCE = [
    "dropoff_datetime", "store_and_fwd_flag", "ratecodeid", "pulocationid", "dolocationid", "passenger_count",
    "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
    "improvement_surcharge", "total_amount", "payment_type", "trip_type", "congestion_surcharge",
]
YELLOW_PREFERENCE = [
    "dropoff_datetime", "passenger_count", "trip_distance", "ratecodeid", "store_and_fwd_flag", "pulocationid",
    "dolocationid", "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge",
]


def stage_services(trips: DataFrame) -> DataFrame:
    """Both services from one table of trips with a ``service`` column, in one pass.

    Gives the rows of ``stage_green`` and ``stage_yellow`` with ``service_type``, without
    deriving or shuffling the trips once per service.
    """
    green = F.col("service") == "Green"
    order = [
        F.when(green, F.struct(*GREEN_PREFERENCE)).asc_nulls_first(),
        F.when(~green, F.struct(*YELLOW_PREFERENCE)).asc_nulls_first(),
    ]
    kept = keep_first(trips.filter(F.col("vendorid").isNotNull()), ["pickup_datetime", "vendorid", "service"], order)
    payment = F.when(green, _float_int(trips, "payment_type")).otherwise(_plain_int(trips, "payment_type"))
    return _typed(
        kept, trips, "pickup_datetime", "dropoff_datetime",
        trip_type=F.when(green, _float_int(trips, "trip_type")).otherwise(F.lit(1)),
        ehail_fee=F.when(green, F.col("ehail_fee")).otherwise(F.lit(0)),
        payment_type=payment,
        more=[F.col("service").alias("service_type")],
    )


def stage_fhv(raw: DataFrame, year: int = 2019) -> DataFrame:
    """For-hire trips of one year that name their base.

    The year is a range, so that it reaches the files' statistics.
    """
    pickup = F.col("pickup_datetime").cast("timestamp")
    first, end = (F.lit(f"{y:04d}-01-01 00:00:00").cast("timestamp") for y in (year, year + 1))
    return raw.filter((pickup >= first) & (pickup < end) & F.col("dispatching_base_num").isNotNull()).select(
        "dispatching_base_num",
        F.col("PULocationID").cast("int").alias("pickup_locationid"),
        F.col("DOLocationID").cast("int").alias("dropoff_locationid"),
        pickup.alias("pickup_datetime"),
        F.col("dropoff_datetime").cast("timestamp").alias("dropoff_datetime"),
        F.col("SR_Flag").alias("sr_flag"),
    )
