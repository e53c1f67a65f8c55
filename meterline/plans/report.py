"""Monthly revenue report as a job: ``python -m meterline.plans.report --input_green ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, functions as F

from meterline.functions.temporal import month_start
from meterline.operators.relational import rename
from meterline.session import build_session
from meterline.sources.layout import write_single_file

# The columns both services share, and the summed columns by their short names.
COMMON_COLUMNS = [
    "VendorID", "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "RatecodeID",
    "PULocationID", "DOLocationID", "passenger_count", "trip_distance", "fare_amount", "extra",
    "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
    "payment_type", "congestion_surcharge",
]
SUMMED = {
    "fare": "fare_amount", "extra": "extra", "mta_tax": "mta_tax", "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount", "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount", "congestion_surcharge": "congestion_surcharge",
}


def both_services(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Trips of both services on the 18 common columns, tagged ``green`` or ``yellow``."""
    sides = []
    for df, prefix, tag in ((green, "lpep", "green"), (yellow, "tpep", "yellow")):
        names = {f"{prefix}_{end}_datetime": f"{end}_datetime" for end in ("pickup", "dropoff")}
        sides.append(rename(df, names).select(COMMON_COLUMNS).withColumn("service_type", F.lit(tag)))
    return sides[0].unionByName(sides[1])


def monthly_location_revenue(trips: DataFrame) -> DataFrame:
    """Revenue per pickup location id, month and service."""
    return trips.groupBy(
        F.col("PULocationID").alias("revenue_zone"),
        month_start(F.col("pickup_datetime")).alias("revenue_month"),
        "service_type",
    ).agg(
        *[F.sum(column).alias(f"revenue_monthly_{name}") for name, column in SUMMED.items()],
        F.avg("passenger_count").alias("avg_monthly_passenger_count"),
        F.avg("trip_distance").alias("avg_monthly_trip_distance"),
    )


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input_green", required=True)
    parser.add_argument("--input_yellow", required=True)
    parser.add_argument("--output", required=True)
    args = parser.parse_args(argv)
    spark = build_session("revenue-report")
    trips = both_services(spark.read.parquet(args.input_green), spark.read.parquet(args.input_yellow))
    write_single_file(monthly_location_revenue(trips), args.output)


if __name__ == "__main__":
    main()
