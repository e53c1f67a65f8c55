"""Declared schemas of the trip sources, messages and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

# Warehouse NUMERIC: precision 38, scale 9.
NUMERIC = T.DecimalType(38, 9)


def _struct(spec: str) -> T.StructType:
    """Schema from ``name type`` pairs; needs no session, unlike DDL parsing."""
    schema = T.StructType()
    for pair in spec.split(", "):
        name, type_name = pair.split(" ")
        schema.add(name, type_name)
    return schema


# Column names and types as the trip files, loads and messages declare them.
GREEN_TRIPS = _struct(
    "VendorID integer, lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp, "
    "store_and_fwd_flag string, RatecodeID integer, PULocationID integer, DOLocationID integer, "
    "passenger_count integer, trip_distance double, fare_amount double, extra double, "
    "mta_tax double, tip_amount double, tolls_amount double, ehail_fee double, "
    "improvement_surcharge double, total_amount double, payment_type integer, trip_type integer, "
    "congestion_surcharge double"
)

YELLOW_TRIPS = _struct(
    "VendorID integer, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
    "passenger_count integer, trip_distance double, RatecodeID integer, store_and_fwd_flag string, "
    "PULocationID integer, DOLocationID integer, payment_type long, fare_amount double, extra double, "
    "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
    "total_amount double, congestion_surcharge double"
)

# Files from 2024 on carry one more column.
YELLOW_TRIPS_2024 = T.StructType(YELLOW_TRIPS.fields + [T.StructField("Airport_fee", T.DoubleType())])

HIGH_VOLUME_TRIPS = _struct(
    "hvfhs_license_num string, dispatching_base_num string, pickup_datetime timestamp, "
    "dropoff_datetime timestamp, PULocationID integer, DOLocationID integer, SR_Flag string"
)

ZONES = _struct("locationid integer, borough string, zone string, service_zone string")

# Landing tables keep ids as text, as the monthly loads deliver them.
LANDING_YELLOW = _struct(
    "VendorID string, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
    "passenger_count integer, trip_distance decimal(38,9), RatecodeID string, "
    "store_and_fwd_flag string, PULocationID string, DOLocationID string, payment_type integer, "
    "fare_amount decimal(38,9), extra decimal(38,9), mta_tax decimal(38,9), "
    "tip_amount decimal(38,9), tolls_amount decimal(38,9), improvement_surcharge decimal(38,9), "
    "total_amount decimal(38,9), congestion_surcharge decimal(38,9)"
)

LANDING_GREEN = _struct(
    "VendorID string, lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp, "
    "store_and_fwd_flag string, RatecodeID string, PULocationID string, DOLocationID string, "
    "passenger_count integer, trip_distance decimal(38,9), fare_amount decimal(38,9), extra decimal(38,9), "
    "mta_tax decimal(38,9), tip_amount decimal(38,9), tolls_amount decimal(38,9), ehail_fee decimal(38,9), "
    "improvement_surcharge decimal(38,9), total_amount decimal(38,9), payment_type integer, trip_type integer, "
    "congestion_surcharge decimal(38,9)"
)

EVENT_MESSAGE = _struct("test_data long, event_timestamp double")

TRIP_MESSAGE = _struct(
    "lpep_pickup_datetime string, lpep_dropoff_datetime string, PULocationID integer, "
    "DOLocationID integer, passenger_count double, trip_distance double, tip_amount double"
)

PRODUCTS_DOCUMENT = T.StructType().add("products", T.ArrayType(_struct("brand string, price double")))

# The given star-schema tables.
TABLES = {
    "region": _struct("r_regionkey integer, r_name string"),
    "nation": _struct("n_nationkey integer, n_name string, n_regionkey integer"),
    "customer": _struct(
        "c_custkey long, c_name string, c_nationkey integer, c_acctbal double, c_mktsegment string"
    ),
    "supplier": _struct("s_suppkey long, s_name string, s_nationkey integer, s_acctbal double"),
    "part": _struct(
        "p_partkey long, p_name string, p_brand string, p_type string, p_size integer, p_retailprice double"
    ),
    "orders": _struct(
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": _struct(
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber integer, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": _struct(
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    ),
    "documents": _struct("doc_id long, text string, lang string, source string, n_chars long"),
    "embeddings": T.StructType().add("vec_id", "long").add("embedding", T.ArrayType(T.FloatType())).add("label", "integer"),
    "pages": _struct("page_id long, url string, html string"),
    "benchmark": _struct("item_id long, text string"),
    "labels": _struct("doc_id long, quality integer, toxic integer"),
    "conversations": _struct("conv_id long, turn long, role string, text string"),
}
