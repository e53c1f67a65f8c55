from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from meterline.operators import aggregates, relational
from meterline.operators.joins import join_null_safe


def test_common_columns_ignore_case_and_keep_left_order(spark, rows):
    left = spark.createDataFrame([(1, 2, "x")], "VendorID int, a int, only_left string")
    right = spark.createDataFrame([(5, 7)], "a bigint, vendorid bigint")
    assert relational.common_columns(left, right) == ["VendorID", "a"]
    united = relational.union_common(left, right, "green", "yellow")
    assert rows(united) == [(1, 2, "green"), (7, 5, "yellow")]
    assert dict(united.dtypes)["VendorID"] == "bigint"


def test_append_fills_missing_columns(spark, rows):
    old = spark.createDataFrame([(1,)], "a int")
    new = spark.createDataFrame([(2, 1.5)], "a int, Airport_fee double")
    assert rows(relational.append_all([old, new])) == [(1, None), (2, 1.5)]


def test_defaults_cover_missing_values_and_columns(spark, rows):
    df = spark.createDataFrame([("A", 1.5), (None, None)], "brand string, price double")
    assert rows(relational.with_default_columns(df, ["brand", "price", "stock"])) == [
        ("A", "1.5", "N/A"), ("N/A", "N/A", "N/A"),
    ]


def test_delete_keeps_rows_with_unknown_condition(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    assert rows(relational.delete_where(df, F.col("v") == 2)) == [(1,), (None,)]


def test_date_ranges_are_half_open(spark, rows):
    times = [datetime(2019, 9, 30, 23, 59, 59), datetime(2019, 10, 1), datetime(2019, 10, 31, 23), datetime(2019, 11, 1)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp")
    assert rows(relational.on_dates(df, "ts", date(2019, 10, 1), date(2019, 11, 1))) == [(times[1],), (times[2],)]
    assert relational.last_days(df, "ts", date(2019, 11, 1), 1).count() == 2


def test_not_in_follows_sql_null_rules(spark, rows):
    probe = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    listed = spark.createDataFrame([(2,)], "v int")
    with_null = spark.createDataFrame([(2,), (None,)], "v int")
    empty = listed.filter("v > 5")
    assert rows(relational.not_in(probe, "k", listed, "v")) == [(1,)]
    assert rows(relational.not_in(probe, "k", with_null, "v")) == []
    assert rows(relational.not_in(probe, "k", empty, "v")) == [(1,), (2,), (None,)]


def test_rows_at_the_maximum(spark, rows):
    df = spark.createDataFrame([(1, "a"), (3, "b"), (3, "c"), (None, "d")], "v int, n string")
    assert rows(relational.at_maximum(df, "v")) == [(3, "b"), (3, "c")]


def test_drifting_types_are_evened_out(spark, rows):
    df = spark.createDataFrame([("1", 7, "x")], "SR_Flag string, PUlocationID int, base string")
    even = relational.cast_present(df, {"sr_flag": "double", "PUlocationID": "double", "DOlocationID": "double"})
    assert rows(even) == [(1.0, 7.0, "x")]


def test_add_column(spark, rows):
    df = relational.add_column(spark.range(1), "status", "string", "Active")
    assert rows(df) == [(0, "Active")]


def test_null_keys_meet_in_null_safe_joins(spark, rows):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "k int, r string")
    assert rows(join_null_safe(left, right, ["k"])) == [(1, "a", "x"), (None, "b", "y")]


def test_bucket_edges_belong_to_the_lower_bucket(spark, rows):
    df = spark.createDataFrame([(0.5,), (1.0,), (1.01,), (3.0,), (7.0,), (10.0,), (10.5,), (None,)], "trip_distance double")
    assert rows(aggregates.distance_buckets(df)) == [
        ("(1, 3]", 2), ("(3, 7]", 1), ("(7, 10]", 1), ("<= 1", 2), ("> 10", 1),
    ]


def test_hourly_revenue_in_three_spellings(spark, rows):
    data = [
        (datetime(2020, 1, 1, 0, 5), 7, 10.5), (datetime(2020, 1, 1, 0, 59), 7, 1.5),
        (datetime(2020, 1, 1, 1, 0), 7, 2.0), (datetime(2020, 1, 1, 0, 30), 8, 4.0),
        (datetime(2019, 12, 31, 23, 59), 7, 100.0),
    ]
    df = spark.createDataFrame(data, "lpep_pickup_datetime timestamp, PULocationID int, total_amount double")
    since = "2020-01-01 00:00:00"
    frame = aggregates.hourly_revenue(df, "lpep_pickup_datetime", "PULocationID", since)
    keyed = aggregates.hourly_revenue_by_key(df, "lpep_pickup_datetime", "PULocationID", since)
    pairs = (
        df.rdd.filter(lambda r: r.lpep_pickup_datetime >= datetime(2020, 1, 1))
        .map(lambda r: ((r.lpep_pickup_datetime.replace(minute=0, second=0), r.PULocationID), (r.total_amount, 1)))
        .reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]))
        .map(lambda kv: (*kv[0], *kv[1])).collect()
    )
    wanted = [(datetime(2020, 1, 1, 0), 7, 12.0, 2), (datetime(2020, 1, 1, 0), 8, 4.0, 1), (datetime(2020, 1, 1, 1), 7, 2.0, 1)]
    assert rows(frame) == wanted and rows(keyed) == wanted and sorted(pairs) == wanted


def test_amounts_that_are_missing(spark, rows):
    df = spark.createDataFrame([(datetime(2020, 1, 1), 7, None), (datetime(2020, 1, 1), 7, 2.0)], "p timestamp, z int, total_amount double")
    assert rows(aggregates.hourly_revenue(df, "p", "z"), "amount", "number_records") == [(2.0, 2)]
    assert rows(aggregates.hourly_revenue_by_key(df, "p", "z"), "revenue", "count") == [(2.0, 1)]


def test_ordinals_and_ctes_work_in_sql(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "k string, v int")
    got = spark.sql("WITH s AS (SELECT * FROM {df} WHERE v > 1) SELECT k, sum(v) AS v FROM s GROUP BY 1 ORDER BY 2 DESC", df=df)
    assert [tuple(r) for r in got.collect()] == [("b", 5), ("a", 2)]


def test_outer_joins(spark, rows):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(2,), (3,)], "k int")
    sizes = {how: left.join(right, "k", how).count() for how in ("left", "right", "outer", "inner")}
    assert sizes == {"left": 2, "right": 2, "outer": 3, "inner": 1}
