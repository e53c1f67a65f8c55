"""Grouped reports over trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from meterline.functions.temporal import fractional_hours, hour_start


def bucket_label(value: Column, edges: Sequence[float]) -> Column:
    """Name of the half-open bucket ``(lower, upper]`` that holds the value."""
    label = F.when(value <= edges[0], f"<= {edges[0]}")
    for lower, upper in zip(edges, edges[1:]):
        label = label.when(value <= upper, f"({lower}, {upper}]")
    return label.when(value > edges[-1], f"> {edges[-1]}")


def distance_buckets(trips: DataFrame, distance: str = "trip_distance", edges: Sequence[float] = (1, 3, 7, 10)) -> DataFrame:
    """Trips per distance bucket, in one pass; trips without a distance are left out."""
    return (
        trips.groupBy(bucket_label(F.col(distance), edges).alias("bucket"))
        .agg(F.count("*").alias("trips"))
        .filter(F.col("bucket").isNotNull())
    )


def hourly_revenue(trips: DataFrame, pickup: str, zone: str, since: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Amount and number of trips per pickup hour and zone, and per further columns ``by``."""
    if since is not None:
        trips = trips.filter(F.col(pickup) >= F.lit(since).cast("timestamp"))
    return trips.groupBy(hour_start(F.col(pickup)).alias("hour"), F.col(zone).alias("zone"), *by).agg(
        F.sum("total_amount").alias("amount"), F.count("*").alias("number_records")
    )


def hourly_revenue_by_key(trips: DataFrame, pickup: str, zone: str, since: str | None = None) -> DataFrame:
    """``hourly_revenue`` spelt as a key combiner: add up (amount, count) pairs per (hour, zone).

    Rows without an amount are dropped first, as adding NULL to a number has no
    answer in this form.
    """
    if since is not None:
        trips = trips.filter(F.col(pickup) >= F.lit(since).cast("timestamp"))
    pairs = trips.filter(F.col("total_amount").isNotNull()).select(
        F.struct(hour_start(F.col(pickup)).alias("hour"), F.col(zone).alias("zone")).alias("key"),
        F.col("total_amount").alias("amount"),
        F.lit(1).alias("one"),
    )
    combined = pairs.groupBy("key").agg(F.sum("amount").alias("revenue"), F.sum("one").alias("count"))
    return combined.select("key.hour", "key.zone", "revenue", "count")


def longest_per_day(trips: DataFrame, pickup: str, dropoff: str) -> DataFrame:
    """Longest trip in hours per pickup day."""
    return trips.groupBy(F.to_date(pickup).alias("pickup_date")).agg(
        F.max(fractional_hours(F.col(pickup), F.col(dropoff))).alias("max_duration")
    )


def daily_location_stats(trips: DataFrame, dropoff: str, location: str) -> DataFrame:
    """Trips, largest total and largest party per drop-off day and location."""
    return trips.groupBy(F.to_date(dropoff).alias("day"), F.col(location).alias("location")).agg(
        F.count("*").alias("count"),
        F.max("total_amount").alias("max_total_amount"),
        F.max("passenger_count").alias("max_passenger_count"),
    )


def average_rounded(df: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """Average per group to two decimals."""
    return df.groupBy(by).agg(F.round(F.avg(value), 2).alias(name))
