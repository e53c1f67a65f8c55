"""Scalar functions, each on every trip or event."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.functions import casts, decode, keys, temporal, text
from meterline.registry import checks
from meterline.registry.book import query
from meterline.registry.checks import surrogate_key
from meterline.registry.models import zones
from meterline.operators.dimensions import with_both_zones
from meterline.sources import roles
from meterline.streaming.messages import parse_trips
from meterline.registry.scans import trip_messages


@query(
    "safe_cast_chain",
    f"""WITH {checks.TRIPS} SELECT ratecodeid,
        CASE WHEN regexp_full_match(ratecodeid, '-?[0-9]+') THEN CAST(ratecodeid AS INTEGER) END AS plain_int,
        CAST(round(TRY_CAST(ratecodeid AS DOUBLE)) AS INTEGER) AS via_double,
        TRY_CAST(store_and_fwd_flag AS INTEGER) AS not_a_number, count(*) AS n
        FROM trips GROUP BY 1, 2, 3, 4""",
)
def safe_cast_chain(spark, sf_dir):
    cast = roles.trips(spark, sf_dir).select(
        "ratecodeid",
        casts.safe_int(F.col("ratecodeid")).alias("plain_int"),
        casts.int_via_double(F.col("ratecodeid")).alias("via_double"),
        casts.safe_int(F.col("store_and_fwd_flag")).alias("not_a_number"),
    )
    return cast.groupBy(*cast.columns).agg(F.count("*").alias("n"))


@query(
    "payment_type_desc",
    f"""WITH {checks.TRIPS} SELECT payment_type, {checks.LABEL} AS description, count(*) AS n
        FROM trips GROUP BY 1, 2""",
)
def payment_type_desc(spark, sf_dir):
    trips = roles.trips(spark, sf_dir)
    return trips.groupBy(
        "payment_type", decode.payment_type_description(F.col("payment_type")).alias("description")
    ).agg(F.count("*").alias("n"))


@query(
    "surrogate_key",
    f"WITH {checks.TRIPS} SELECT {surrogate_key('vendorid', 'pickup_datetime')} AS tripid, service FROM trips",
)
def surrogate_key_query(spark, sf_dir):
    return roles.trips(spark, sf_dir).select(
        keys.surrogate_key(F.col("vendorid"), F.col("pickup_datetime")).alias("tripid"), "service"
    )


_HASH_5 = """coalesce(CAST(vendorid AS VARCHAR), '') || CAST(pickup_datetime AS VARCHAR)
    || CAST(dropoff_datetime AS VARCHAR) || CAST(pulocationid AS VARCHAR) || CAST(dolocationid AS VARCHAR)"""
_HASH_7 = _HASH_5 + """ || CAST(CAST(fare_amount AS DECIMAL(12,2)) AS VARCHAR)
    || CAST(CAST(trip_distance AS DECIMAL(12,2)) AS VARCHAR)"""


@query("row_hash_pg", f"WITH {checks.TRIPS} SELECT md5({_HASH_7}) AS unique_row_id FROM trips")
def row_hash_pg(spark, sf_dir):
    names = ["vendorid", "pickup_datetime", "dropoff_datetime", "pulocationid", "dolocationid", "fare_amount"]
    parts = [*[F.col(name) for name in names], F.col("trip_distance").cast("decimal(12,2)")]
    return roles.trips(spark, sf_dir).select(keys.row_hash(*parts).alias("unique_row_id"))


@query("row_hash_bq", f"WITH {checks.TRIPS} SELECT md5({_HASH_5}) AS unique_row_id FROM trips")
def row_hash_bq(spark, sf_dir):
    names = ["vendorid", "pickup_datetime", "dropoff_datetime", "pulocationid", "dolocationid"]
    hashed = keys.row_hash_bytes(*[F.col(name) for name in names])
    # Shown as hex, the form both engines print alike.
    return roles.trips(spark, sf_dir).select(F.lower(F.hex(hashed)).alias("unique_row_id"))


@query(
    "trip_zone_labels",
    f"""WITH {checks.ZONES}, {checks.TRIPS} SELECT pickup_datetime, dropoff_datetime,
        {checks.money('total_amount')}, pz.borough || '/' || pz.zone AS pickup_loc,
        dz.borough || '/' || dz.zone AS dropoff_loc
        FROM trips JOIN dim_zones pz ON pulocationid = pz.locationid
        JOIN dim_zones dz ON dolocationid = dz.locationid""",
)
def trip_zone_labels(spark, sf_dir):
    joined = with_both_zones(
        roles.trips(spark, sf_dir), zones(spark, sf_dir), "pulocationid", "dolocationid"
    )
    return joined.select(
        "pickup_datetime", "dropoff_datetime", F.col("total_amount").cast("double").alias("total_amount"),
        text.zone_label(F.col("pickup_borough"), F.col("pickup_zone")).alias("pickup_loc"),
        text.zone_label(F.col("dropoff_borough"), F.col("dropoff_zone")).alias("dropoff_loc"),
    )


@query(
    "trip_duration",
    f"""WITH {checks.TRIPS} SELECT date_sub('second', pickup_datetime, dropoff_datetime) AS seconds,
        count(*) AS n FROM trips GROUP BY 1""",
)
def trip_duration(spark, sf_dir):
    seconds = temporal.elapsed_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return roles.trips(spark, sf_dir).groupBy(seconds.alias("seconds")).agg(F.count("*").alias("n"))


@query(
    "epoch_ms_to_ts",
    "SELECT event_id, date_trunc('millisecond', ts)::TIMESTAMP AS event_time FROM events",
)
def epoch_ms_to_ts(spark, sf_dir):
    # The producer sends milliseconds as a float.
    millis = (F.unix_micros("ts") / 1000).cast("double")
    return roles.events(spark, sf_dir).select(
        "event_id", temporal.from_epoch_millis(millis).alias("event_time")
    )


@query(
    "parse_event_time",
    f"""WITH {checks.TRIPS} SELECT CAST(dropoff_datetime AS VARCHAR) AS text, dropoff_datetime AS dropoff_time,
        CAST(NULL AS TIMESTAMP) AS from_junk FROM trips""",
)
def parse_event_time(spark, sf_dir):
    return parse_trips(trip_messages(spark, sf_dir)).select(
        F.col("lpep_dropoff_datetime").alias("text"),
        "dropoff_time",
        temporal.parse_event_time(F.concat(F.lit("x"), "lpep_dropoff_datetime")).alias("from_junk"),
    )


@query(
    "base_id",
    f"""WITH {checks.FHV}, numbered AS (SELECT *, CAST(substr(dispatching_base_num, 2) AS BIGINT) AS num FROM fhv)
        SELECT dispatching_base_num,
          CASE WHEN num % 7 = 0 THEN 's' WHEN num % 3 = 0 THEN 'a' ELSE 'e' END || '/' ||
          CASE WHEN length(to_hex(num)) < 3 THEN lpad(lower(to_hex(num)), 3, '0') ELSE lower(to_hex(num)) END
            AS base_id,
          CAST(pickup_datetime AS DATE) AS pickup_date, CAST(dropoff_datetime AS DATE) AS dropoff_date
        FROM numbered WHERE num IS NOT NULL""",
)
def base_id(spark, sf_dir):
    trips = roles.fhv_trips(spark, sf_dir).filter("dispatching_base_num IS NOT NULL")
    return trips.select(
        "dispatching_base_num",
        text.base_id(F.col("dispatching_base_num")).alias("base_id"),
        F.to_date("pickup_datetime").alias("pickup_date"),
        F.to_date("dropoff_datetime").alias("dropoff_date"),
    )
