from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterline.operators.dimensions import known_zones, with_both_zones, zone_dimension
from meterline.plans import marts, report, staging

AT = datetime(2020, 3, 31, 23, 50)


def raw_trip(prefix, **changes):
    row = {
        "VendorID": "1", f"{prefix}_pickup_datetime": AT, f"{prefix}_dropoff_datetime": datetime(2020, 4, 1, 0, 5),
        "store_and_fwd_flag": "N", "RatecodeID": "1.0", "PULocationID": "1", "DOLocationID": "2",
        "passenger_count": 1, "trip_distance": 2.5, "fare_amount": 10.1, "extra": 0.5, "mta_tax": 0.5,
        "tip_amount": 2.0, "tolls_amount": 0.0, "improvement_surcharge": 0.3, "total_amount": 13.4,
        "payment_type": "1.0", "congestion_surcharge": 0.0,
    }
    if prefix == "lpep":
        row |= {"ehail_fee": None, "trip_type": "2.0"}
    return row | changes


TYPES = {
    "VendorID": "string", "lpep_pickup_datetime": "timestamp", "lpep_dropoff_datetime": "timestamp",
    "tpep_pickup_datetime": "timestamp", "tpep_dropoff_datetime": "timestamp", "store_and_fwd_flag": "string",
    "RatecodeID": "string", "PULocationID": "string", "DOLocationID": "string", "passenger_count": "int",
    "payment_type": "string", "trip_type": "string",
}


def raw(spark, prefix, *changes):
    data = [raw_trip(prefix, **change) for change in (changes or ({},))]
    schema = ", ".join(f"{name} {TYPES.get(name, 'double')}" for name in data[0])
    return spark.createDataFrame([tuple(row.values()) for row in data], schema)


@pytest.fixture
def zones(spark):
    return spark.createDataFrame(
        [(1, "EWR", "Newark Airport", "EWR"), (2, "Queens", "Jamaica Bay", "Boro Zone"), (264, "Unknown", "NV", "N/A"),
         (9, None, "Nowhere", None)],
        "locationid int, borough string, zone string, service_zone string",
    )


def test_green_codes_come_through_two_casts(spark):
    row = staging.stage_green(raw(spark, "lpep")).first()
    assert (row.vendorid, row.ratecodeid, row.trip_type, row.payment_type) == (1, 1, 2, 1)
    assert row.payment_type_description == "Credit card"
    assert row.fare_amount == Decimal("10.1") and row.ehail_fee is None


def test_yellow_payment_code_and_label_disagree(spark):
    row = staging.stage_yellow(raw(spark, "tpep")).first()
    assert (row.payment_type, row.payment_type_description, row.trip_type, row.ehail_fee) == (0, "Credit card", 1, 0)


def test_staging_drops_unknown_vendors_and_repeats(spark):
    df = raw(spark, "lpep", {}, {"total_amount": 1.0}, {"VendorID": None}, {"VendorID": "2"})
    kept = staging.stage_green(df)
    assert sorted((r.vendorid, float(r.total_amount)) for r in kept.collect()) == [(1, 1.0), (2, 13.4)]
    assert kept.select("tripid").distinct().count() == 2


def test_fhv_staging(spark):
    data = [("B1", datetime(2019, 1, 1)), ("B2", datetime(2018, 12, 31, 23, 59)), (None, datetime(2019, 5, 5))]
    df = spark.createDataFrame(
        [(base, at, at, "7", None, None) for base, at in data],
        "dispatching_base_num string, pickup_datetime timestamp, dropoff_datetime timestamp, PULocationID string, "
        "DOLocationID string, SR_Flag string",
    )
    staged = staging.stage_fhv(df)
    assert [(r.dispatching_base_num, r.pickup_locationid) for r in staged.collect()] == [("B1", 7)]


def test_zone_names(spark, zones, rows):
    assert rows(zone_dimension(zones), "service_zone")[1] == ("Green Zone",)
    assert known_zones(zones).count() == 2


def facts(spark, zones, green=({},), yellow=({},)):
    return marts.fact_trips(
        staging.stage_green(raw(spark, "lpep", *green)), staging.stage_yellow(raw(spark, "tpep", *yellow)),
        zone_dimension(zones),
    )


def test_facts_lose_trips_of_unknown_zones(spark, zones):
    df = facts(spark, zones, green=({}, {"DOLocationID": "264", "VendorID": "2"}, {"PULocationID": "77", "VendorID": "3"}))
    assert df.columns == marts.FACT_COLUMNS and len(df.columns) == 26
    assert sorted((r.service_type, r.pickup_zone, r.dropoff_borough) for r in df.collect()) == [
        ("Green", "Newark Airport", "Queens"), ("Yellow", "Newark Airport", "Queens"),
    ]


def test_month_and_quarter_edges(spark, zones):
    april = {"lpep_pickup_datetime": datetime(2020, 4, 1), "lpep_dropoff_datetime": datetime(2020, 4, 1, 1)}
    df = facts(spark, zones, green=({}, april))
    monthly = marts.monthly_zone_revenue(df).filter("service_type = 'Green'")
    assert sorted((r.revenue_month, r.total_monthly_trips) for r in monthly.collect()) == [
        (datetime(2020, 3, 1), 1), (datetime(2020, 4, 1), 1),
    ]
    quarterly = marts.quarterly_revenue(df).filter("service_type = 'Green'")
    assert sorted((r.revenue_year_quarter, r.revenue_month_number) for r in quarterly.collect()) == [
        ("2020/Q1", 3), ("2020/Q2", 4),
    ]
    totals = {(r.revenue_quarter, r.service_type): r.total_revenue for r in marts.quarterly_totals(quarterly).collect()}
    assert totals == {(1, "Green"): Decimal("13.4"), (2, "Green"): Decimal("13.4")}


def test_growth_without_a_prior_year(spark):
    totals = spark.createDataFrame(
        [(2019, 1, "Green", 50.0), (2020, 1, "Green", 75.0), (2020, 1, "Yellow", 3.0), (2021, 1, "Yellow", 0.0), (2022, 1, "Yellow", 5.0)],
        "revenue_year int, revenue_quarter int, service_type string, total_revenue double",
    )
    got = {(r.revenue_year, r.service_type): r.yoy_growth_percentage for r in marts.yoy_growth(totals).collect()}
    assert got == {
        (2019, "Green"): 5000.0, (2020, "Green"): 50.0, (2020, "Yellow"): 300.0, (2021, "Yellow"): -100.0,
        (2022, "Yellow"): None,
    }


def test_fare_percentiles_use_the_real_label(spark, zones):
    df = facts(spark, zones, yellow=({}, {"VendorID": "2", "payment_type": "2"}, {"VendorID": "3", "payment_type": "3"}))
    both = marts.fare_percentiles(df, (0.5,)).filter("service_type = 'Yellow'").first()
    assert both.p50_fare == 10.1
    assert marts.fare_p95_rows(df).filter("service_type = 'Yellow'").count() == 2
    # The misspelt label leaves cash trips only.
    misspelt = marts.fare_p95_rows(df, ("Cash", "Credit Card"))
    assert [r.service_type for r in misspelt.collect()] == ["Yellow"]


def travel(spark):
    pairs = {("SoHo", "A"): [100, 100], ("SoHo", "B"): [50, 50, 50], ("SoHo", "C"): [10], ("JFK", "A"): [5]}
    data = [
        (2019, 11, start, end, seconds, 1, ord(end))
        for (start, end), durations in pairs.items() for seconds in durations
    ]
    return spark.createDataFrame(
        data, "year int, month int, pickup_zone string, dropoff_zone string, trip_duration bigint, "
        "pickup_locationid int, dropoff_locationid int",
    )


def test_second_longest_travel_time(spark):
    once = marts.second_longest_p90(travel(spark), 2019, 11, ["SoHo", "JFK"])
    assert [tuple(r) for r in once.collect()] == [("SoHo", "B", 50.0)]
    per_trip = marts.second_longest_p90(travel(spark), 2019, 11, ["SoHo"], distinct=False)
    assert [tuple(r) for r in per_trip.collect()] == [("SoHo", "B", 50.0)] * 3


def test_fhv_travel_times(spark, zones):
    at = datetime(2019, 11, 5, 10)
    df = spark.createDataFrame(
        [("B1", 1, 2, at, datetime(2019, 11, 5, 10, 1, 1), None), ("B2", 264, 2, at, at, None)],
        "dispatching_base_num string, pickup_locationid int, dropoff_locationid int, pickup_datetime timestamp, "
        "dropoff_datetime timestamp, sr_flag string",
    )
    rows = marts.fhv_travel_times(marts.fact_fhv_trips(df, zone_dimension(zones))).collect()
    assert [(r.year, r.month, r.pickup_zone, r.trip_duration, r.service_type) for r in rows] == [
        (2019, 11, "Newark Airport", 61, "Fhv"),
    ]


def test_report_job_writes_one_file(spark, tmp_path, monkeypatch):
    raw(spark, "lpep").write.parquet(str(tmp_path / "green"))
    raw(spark, "tpep", {}, {"VendorID": "2"}).write.parquet(str(tmp_path / "yellow"))
    out = tmp_path / "report"
    for _ in range(2):
        report.main(["--input_green", str(tmp_path / "green"), "--input_yellow", str(tmp_path / "yellow"), "--output", str(out)])
    assert len(list(out.glob("part-*.parquet"))) == 1
    got = {(r.service_type, r.revenue_zone): r.revenue_monthly_total_amount for r in spark.read.parquet(str(out)).collect()}
    assert got == {("green", "1"): 13.4, ("yellow", "1"): 26.8}


def test_both_zone_roles(spark, zones, rows):
    trips = spark.createDataFrame([(1, 2), (2, None)], "pickup_locationid int, dropoff_locationid int")
    assert rows(with_both_zones(trips, zones), "pickup_zone", "dropoff_zone") == [("Newark Airport", "Jamaica Bay")]


def test_one_pass_stages_what_two_do(spark, rows):
    from meterline.sources import roles

    sf = "/root/testdata/sf0.001"
    once = staging.stage_services(roles.trips(spark, sf))
    twice = staging.stage_green(roles.green_trips(spark, sf)).withColumn("service_type", F.lit("Green")).unionByName(
        staging.stage_yellow(roles.yellow_trips(spark, sf)).withColumn("service_type", F.lit("Yellow")))
    assert rows(once, *sorted(once.columns)) == rows(twice, *sorted(once.columns))
