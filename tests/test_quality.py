from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from meterline.operators import quality


def test_single_checks(spark, rows):
    df = spark.createDataFrame([("a", 1, 7), ("a", 9, None), ("b", None, 0), (None, 1, 7), (None, 1, 7)], "id string, zone int, code int")
    zones = spark.createDataFrame([(1,), (2,)], "locationid int")
    assert rows(quality.duplicate_keys(df, "id")) == [("a", 2)]
    assert rows(quality.null_counts(df, ["id", "zone"])) == [("id", 2), ("zone", 1)]
    assert rows(quality.orphans(df, "zone", zones, "locationid"), "zone") == [(9,)]
    assert rows(quality.unaccepted_values(df, "code", [1, 2, 7])) == [(0, 1)]


def test_report_and_severity(spark):
    df = spark.createDataFrame([("a", 1), ("a", 9), ("c", None)], "id string, zone int")
    zones = spark.createDataFrame([(1,), (1,)], "locationid int")
    flagged = quality.flag_orphans(df, "zone", zones, "locationid", "orphan")
    assert flagged.count() == 3
    checks = [
        quality.RowCheck("zone_known", F.col("orphan"), "warn"),
        quality.RowCheck("id_present", F.col("id").isNull()),
    ]
    lines = quality.report(flagged, checks, [quality.KeyCheck("id_unique", "id")])
    got = {r.check_name: (r.failures, r.severity, r.status) for r in lines.collect()}
    assert got == {
        "zone_known": (1, "warn", "warn"), "id_present": (0, "error", "pass"), "id_unique": (1, "error", "error"),
    }
    with pytest.raises(ValueError, match="id_unique"):
        quality.stop_on_error(lines)
    quality.stop_on_error(quality.report(flagged, checks))


@pytest.mark.parametrize("hours, status", [(1, "pass"), (30, "warn"), (60, "error")])
def test_freshness(spark, hours, status):
    df = spark.createDataFrame([(datetime(2020, 1, 1),), (datetime(2019, 1, 1),)], "ts timestamp")
    as_of = datetime(2020, 1, 1 + hours // 24, hours % 24)
    row = quality.freshness(df, "ts", as_of, 24, 48).first()
    assert (row.age_hours, row.status) == (hours, status)


def test_freshness_of_an_empty_source(spark):
    df = spark.createDataFrame([], "ts timestamp")
    assert quality.freshness(df, "ts", datetime(2020, 1, 1), 24, 48).first().status == "error"
