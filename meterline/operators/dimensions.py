"""Zone dimension and its role-playing joins.

No broadcast hint is used: the zone table has a known small size, so Spark's own
size check (``spark.sql.autoBroadcastJoinThreshold``) broadcasts it, and a
lookup that outgrows the threshold falls back to a sort-merge join with AQE skew
handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def zone_dimension(seed: DataFrame) -> DataFrame:
    """Zones with the green service area named as such."""
    return seed.select(
        "locationid", "borough", "zone",
        F.replace(F.col("service_zone"), F.lit("Boro"), F.lit("Green")).alias("service_zone"),
    )


def known_zones(zones: DataFrame) -> DataFrame:
    """Zones whose borough is known; a NULL borough is not."""
    return zones.filter(F.col("borough") != "Unknown")


def with_both_zones(
    trips: DataFrame, zones: DataFrame,
    pickup: str = "pickup_locationid", dropoff: str = "dropoff_locationid",
) -> DataFrame:
    """Inner-join the zones twice and add borough and zone of both trip ends."""
    for role, key in (("pickup", pickup), ("dropoff", dropoff)):
        side = zones.select(
            F.col("locationid").alias(f"_{role}_id"),
            F.col("borough").alias(f"{role}_borough"),
            F.col("zone").alias(f"{role}_zone"),
        )
        trips = trips.join(side, F.col(key) == F.col(f"_{role}_id")).drop(f"_{role}_id")
    return trips
