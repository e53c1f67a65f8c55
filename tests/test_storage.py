from __future__ import annotations

import random
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterline.functions import text
from meterline.functions.catalog import base_codes, define_functions
from meterline.operators import sketches
from meterline.registry import storage
from meterline.sources import files, footers, layout
from tests.test_plans import plan

SF = "/root/testdata/sf0.001"


def test_counts_come_from_footers(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    spark.range(1000).select((F.col("id") % 3).alias("part"), "id", F.lit("x" * 50).alias("wide")).write.partitionBy("part").parquet(path)
    counts = footers.partition_counts(spark, path, "part")
    assert "PushedAggregation: [COUNT(*)]" in plan(counts) and "PushedGroupBy: [part]" in plan(counts)
    assert rows(counts) == [(0, 334), (1, 333), (2, 333)]
    ranges = footers.column_ranges(spark, path, ["id"])
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id)]" in plan(ranges)
    assert rows(ranges) == [(1000, 0, 999)]


def test_file_metadata_states_what_a_scan_finds(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(500).select(
        "id", F.when(F.col("id") % 7 == 0, F.col("id").cast("int")).alias("holes"), F.lit(None).cast("int").alias("empty"),
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("text"))
    df.repartition(3).write.parquet(path)
    found = footers.file_metadata(spark, path)
    totals = {r.column_name: r for r in found.groupBy("column_name").agg(
        F.count("*").alias("files"), F.sum("n_rows").alias("n"), F.sum("null_count").alias("nulls"), F.min("low").alias("low"), F.max("high").alias("high")).collect()}
    assert {name: (r.files, r.n, r.nulls) for name, r in totals.items()} == {
        "id": (3, 500, 0), "holes": (3, 500, 428), "empty": (3, 500, 500), "text": (3, 500, 0)}
    assert (totals["text"].low, totals["text"].high) == ("s0", "s99") and totals["empty"].low is None
    ids = found.filter("column_name = 'id'").agg(F.min(F.col("low").cast("int")), F.max(F.col("high").cast("int"))).first()
    assert tuple(ids) == (0, 499)
    assert footers.file_metadata(spark, path).filter("row_groups < 1 or file_bytes < stored_bytes").count() == 0


def test_bucketed_tables_join_and_group_without_a_shuffle(spark):
    text_of = plan(storage.bucketed_join(spark, SF))
    assert "SortMergeJoin" in text_of and "Exchange" not in text_of


def test_clustering_by_two_columns_skips_on_both(spark, tmp_path):
    rnd = random.Random(3)
    df = spark.createDataFrame([(rnd.randrange(1000), rnd.randrange(1000), k) for k in range(8000)], "a int, b int, k int")
    by_one, by_both = str(tmp_path / "one"), str(tmp_path / "both")
    df.repartitionByRange(16, "a").sortWithinPartitions("a").write.parquet(by_one)
    layout.write_clustered(df, by_both, ["a", "b"], files=16)
    assert spark.read.parquet(by_both).exceptAll(df).count() == 0 and spark.read.parquet(by_both).count() == 8000

    def read(path, column):
        """Row groups whose stated range touches the lowest eighth."""
        stated = footers.file_metadata(spark, path).filter(F.col("column_name") == column)
        return stated.filter(F.col("low").cast("int") < 125).count()

    assert read(by_one, "a") + read(by_one, "b") >= 16
    assert read(by_both, "a") <= 6 and read(by_both, "b") <= 6


def test_clustering_places_nulls_and_equal_values(spark, tmp_path, rows):
    df = spark.createDataFrame([(None, 5.0, 1), (1, None, 2), (1, 5.0, 3), (1, 5.0, 3), (None, None, 4)], "a int, b double, k int")
    layout.write_clustered(df, str(tmp_path / "t"), ["a", "b"], files=2, bits=3)
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == rows(df)
    layout.write_clustered(df.limit(0), str(tmp_path / "none"), ["a", "b"], files=2)
    assert spark.read.schema(df.schema).parquet(str(tmp_path / "none")).count() == 0


def test_every_csv_line_is_read_or_set_aside(spark, tmp_path, rows):
    schema = StructType.fromDDL("name string, n int, at timestamp")
    lines = ["name,n,at", "a,1,2020-01-01 00:00:00", '"b, c",2,2020-01-02 03:04:05', "short,3", 'long,4,2020-01-01 00:00:00,"x,y"', "bad,x,2020-01-01 00:00:00",
             "time,5,yesterday", ",,", "", '"q ""x"", y",6,']
    (tmp_path / "one.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "two.csv").write_text("name,n,at\nz,9,2021-01-01 00:00:00\nonly\n")
    good, bad = files.read_csv_checked(spark, str(tmp_path), schema)
    assert sorted((r.name or "", r.n or 0, r.at) for r in good.collect()) == sorted([
        ("a", 1, datetime(2020, 1, 1)), ("b, c", 2, datetime(2020, 1, 2, 3, 4, 5)), ("", 0, None), ('q "x", y', 6, None), ("z", 9, datetime(2021, 1, 1))],
        key=lambda x: x[:2])
    assert rows(bad.select(F.element_at(F.split("file", "/"), -1), "reason", "line")) == sorted([
        ("one.csv", "short", "short,3"), ("one.csv", "long", 'long,4,2020-01-01 00:00:00,"x,y"'), ("one.csv", "unreadable", "bad,x,2020-01-01 00:00:00"),
        ("one.csv", "unreadable", "time,5,yesterday"), ("two.csv", "short", "only")], key=repr)


def test_ranges_of_days_are_answered_from_sketches(spark, tmp_path):
    df = spark.range(60_000).select((F.col("id") % 30).cast("int").alias("day"), (F.xxhash64("id") % 20_000).alias("user"))
    path = str(tmp_path / "sketches")
    sketches.distinct_sketches(df, ["day"], "user").write.parquet(path)
    stored = spark.read.parquet(path)
    for low, high in ((0, 30), (3, 4), (10, 20)):
        chosen = F.col("day").between(low, high - 1)
        estimate = sketches.merged_estimate(stored.filter(chosen))
        assert "user" not in plan(estimate)
        exact = df.filter(chosen).agg(F.count_distinct("user")).first()[0]
        assert abs(estimate.first()[0] - exact) <= 3 * sketches.standard_error() * exact
        assert spark.range(1).select(sketches.within_error(F.lit(estimate.first()[0]), F.lit(exact))).first()[0]


def test_catalog_functions_equal_the_library(spark):
    define_functions(spark)
    bases = ["B02884", "B00021", "B00014", "B00003", "B", "", None, "Bx12", "B99999999999", "B 7"]
    spark.createDataFrame([(x,) for x in bases], "base string").createOrReplaceTempView("bases")
    found = spark.sql("SELECT base, base_code(base) AS a, base_code_arrow(base) AS b FROM bases").collect()
    want = {r.base: r.code for r in spark.table("bases").select("base", text.base_id(F.col("base")).alias("code")).collect()}
    assert {r.base: r.a for r in found} == want
    assert {r.base: r.b for r in found} == want
    assert base_codes(pa.array(["B02884", None])).to_pylist() == ["s/b44", None]
    text_of = plan(storage.sql_functions(spark, SF))
    assert "CASE WHEN" in text_of and "Python" not in text_of and "Arrow" not in text_of  # the body is part of the plan


@pytest.mark.parametrize("name", ["approx_distinct_pickups"])
def test_estimates_are_estimates(spark, name):
    from __spark_entry__ import queries

    row = queries()[name](spark, SF).first()
    assert row.within_error and row.pickups > 0
