"""Plans must keep the properties that let them scale."""

from __future__ import annotations

from contextlib import redirect_stdout
from io import StringIO

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from meterline.registry.scans import by_dropoff_date
from meterline.sources import roles

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_date_filters_prune_partitions(spark):
    stored = by_dropoff_date(spark, SF)
    text = plan(stored.filter(F.col("dropoff_date").between("1998-03-01", "1998-03-15")).select("vendorid"))
    assert "PartitionFilters: [isnotnull(dropoff_date" in text
    assert "ReadSchema: struct<vendorid:int>" in text


def test_zones_are_broadcast_and_dedup_is_limited_before_the_shuffle(spark):
    text = plan(queries()["fact_trips"](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    head, exchange, below = text.partition("Exchange")
    assert "WindowGroupLimit" in text and text.count("WindowGroupLimit (") >= 2
    assert "dim-zones" in text


def scans(text: str, table: str) -> list[str]:
    """Details of the scans of one given table."""
    return [part for part in text.split("\n\n") if "Scan parquet" in part and f"/{table}.parquet" in part]


def test_trips_are_derived_once(spark):
    assert len(scans(plan(queries()["fact_trips"](spark, SF)), "lineitem")) == 1
    for name in ("zone_hour_join", "merge_insert_only", "merge_upsert", "longest_trip_subquery"):
        # These store their trips first and read the copy.
        assert scans(plan(queries()[name](spark, SF)), "lineitem") == []


def test_service_and_days_reach_the_scan(spark):
    (items,) = scans(plan(queries()["hourly_revenue"](spark, SF)), "lineitem")
    assert "EqualTo(l_linestatus,O)" in items
    for name in ("count_on_day", "date_range_scan", "param_query", "largest_tip", "top_pickup_zones", "stg_fhv"):
        (orders,) = scans(plan(queries()[name](spark, SF)), "orders")
        assert "GreaterThanOrEqual(o_orderdate," in orders and "LessThan(o_orderdate," in orders
    (orders,) = scans(plan(queries()["rolling_days_filter"](spark, SF)), "orders")
    assert "GreaterThanOrEqual(o_orderdate," in orders


def test_time_ranges_reach_the_scan(spark):
    orders = roles.table(spark, SF, "orders")
    text = plan(orders.filter(F.col("o_totalprice") > 100).select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,100.0)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


@pytest.mark.parametrize("name", ["base_id", "hourly_revenue_rdd", "monthly_zone_revenue", "safe_cast_chain"])
def test_no_python_in_native_queries(spark, name):
    assert "Python" not in plan(queries()[name](spark, SF))


def test_scoring_runs_on_arrow_batches(spark):
    assert "MapInPandas" in plan(queries()["predict_rows"](spark, SF))


def test_top_k_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(queries()["longest_trip"](spark, SF))


def test_aggregates_combine_before_the_shuffle(spark):
    text = plan(queries()["monthly_location_revenue"](spark, SF))
    assert "partial_sum" in text
