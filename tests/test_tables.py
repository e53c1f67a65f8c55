from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from meterline.operators import tables


def name():
    return f"t_{uuid.uuid4().hex}"


def test_insert_only_merge_keeps_batch_duplicates_and_null_ids(spark, rows):
    target = spark.createDataFrame([("a", 1)], "id string, v int")
    source = spark.createDataFrame([("a", 9), ("b", 2), ("b", 2), (None, 3)], "id string, v int")
    assert rows(tables.merge_insert_only(target, source, "id")) == [("a", 1), ("b", 2), ("b", 2), (None, 3)]


def test_upsert_replaces_and_takes_one_source_row(spark, rows):
    target = spark.createDataFrame([(1, "x", "old"), (2, "y", "old"), (None, "n", "old")], "k int, n string, o string")
    source = spark.createDataFrame([(2, "b", "new"), (2, "a", "new"), (3, "c", "new"), (None, "m", "new")], "k int, n string, o string")
    assert rows(tables.merge_upsert(target, source, ["k"])) == [
        (1, "x", "old"), (2, "a", "new"), (3, "c", "new"), (None, "m", "new"),
    ]


def test_stored_merge_is_idempotent_with_and_without_a_span(spark, rows):
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), ("c", None)], "id string, at int")
    for within in (None, "at"):
        table = name()
        tables.create_table(spark, table, batch.schema)
        for _ in range(3):
            tables.merge_into_table(spark, table, batch, "id", within)
        tables.merge_into_table(spark, table, spark.createDataFrame([("d", 5), ("a", 1)], batch.schema), "id", within)
        assert rows(spark.table(table)) == [("a", 1), ("b", 2), ("b", 2), ("c", None), ("d", 5)]
        tables.drop_table(spark, table)


def test_create_like_append_truncate_drop(spark, rows):
    first, second = name(), name()
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    tables.create_table(spark, first, df.schema)
    tables.create_table(spark, first, df.schema)
    tables.append_rows(df.select("s", "n"), first)
    tables.create_like(spark, second, first)
    assert rows(spark.table(first)) == [(1, "a")] and spark.table(second).count() == 0
    assert spark.table(second).schema == spark.table(first).schema
    tables.truncate_table(spark, first)
    assert spark.table(first).count() == 0
    tables.drop_table(spark, first)
    tables.drop_table(spark, first)
    assert not spark.catalog.tableExists(first)


def test_replace_may_read_what_it_replaces(spark, rows):
    table = name()
    tables.replace_table(spark.range(3).toDF("v"), table)
    tables.replace_table(spark.table(table).filter("v > 0").withColumn("v", F.col("v") * 10), table)
    assert rows(spark.table(table)) == [(10,), (20,)]
    tables.drop_table(spark, table)
