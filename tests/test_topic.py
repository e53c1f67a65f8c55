from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from meterline.streaming import sinks, topic


def rows_of(spark, low, high, keys=7):
    n = F.col("id")
    return spark.range(low, high).select((n % keys).cast("string").alias("key"), n.cast("string").alias("value"), "id")


class Reader:
    def __init__(self, spark, tmp_path, group, start="earliest", bound=0):
        self.spark, self.topic, self.group, self.start, self.bound = spark, str(tmp_path / "topic"), group, start, bound
        self.out, self.checkpoint = str(tmp_path / f"out-{group}"), str(tmp_path / f"cp-{group}")

    def step(self):
        """One micro-batch of a query that resumes from the checkpoint; the messages it took."""
        stream = topic.read_topic(self.spark, self.topic, 3, self.group, self.start, self.bound)
        query = sinks.append_parquet(stream, self.out, self.checkpoint, available_now=True)
        query.awaitTermination()
        return sum(report.numInputRows for report in query.recentProgress)

    def values(self):
        return sorted(int(r.value) for r in self.spark.read.schema(topic.RECORD).parquet(self.out).collect())


def test_positions_bounds_and_restarts(spark, tmp_path):
    path = str(tmp_path / "topic")
    early, late = Reader(spark, tmp_path, "early", bound=40), Reader(spark, tmp_path, "late", "latest")
    topic.publish(rows_of(spark, 0, 100), path, 3, ["id"])
    assert [early.step(), early.step()] == [40, 40]
    assert late.step() == 0
    topic.publish(rows_of(spark, 100, 150), path, 3, ["id"])
    assert [early.step(), early.step(), early.step()] == [40, 30, 0]
    assert late.step() == 50
    assert early.values() == list(range(150)) and late.values() == list(range(100, 150))
    # Positions of a partition have no gap, and a key keeps its order in one partition.
    read = spark.read.schema(topic.RECORD).parquet(early.out)
    for r in read.groupBy("partition").agg(F.count("*").alias("n"), F.min("position").alias("a"), F.max("position").alias("b"), F.count_distinct("position").alias("d")).collect():
        assert (r.a, r.b, r.d) == (0, r.n - 1, r.n)
    for r in read.groupBy("key").agg(F.count_distinct("partition").alias("p"), F.array_sort(F.collect_list(F.struct("position", "value"))).alias("v")).collect():
        values = [int(x.value) for x in r.v]
        assert r.p == 1 and values == sorted(values)


def test_a_failed_publication_is_never_seen(spark, tmp_path):
    path = str(tmp_path / "topic")
    topic.publish(rows_of(spark, 0, 20), path, 3, ["id"])
    broken = rows_of(spark, 20, 40).withColumn("value", F.when(F.col("id") == 39, F.raise_error(F.lit("stop"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="stop"):
        topic.publish(broken, path, 3, ["id"])
    assert len(glob.glob(f"{path}/log/*.json")) == 1
    # A file that a lost task has left is not in the log.
    spark.createDataFrame([("0", "999")], "key string, value string").write.mode("append").parquet(f"{path}/data")
    reader = Reader(spark, tmp_path, "all")
    assert reader.step() == 20 and reader.values() == list(range(20))


def test_null_keys_and_unknown_starts(spark, tmp_path):
    path = str(tmp_path / "topic")
    topic.publish(spark.createDataFrame([(None, "1"), (None, "2"), ("a", "3")], "key string, value string"), path, 3)
    reader = Reader(spark, tmp_path, "nulls")
    assert reader.step() == 3 and reader.values() == [1, 2, 3]
    with pytest.raises(ValueError, match="earliest or latest"):
        topic.read_topic(spark, path, 3, "x", "middle")


def test_a_range_reads_only_its_row_groups(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    rows = pa.table({"key": ["k"] * 100, "value": [str(n) for n in range(100)]})
    pq.write_table(rows, tmp_path / "part.parquet", row_group_size=10)
    reader, decoded, read = topic.TopicReader({"path": str(tmp_path), "partitions": "1", "group": "g"}), [], pq.ParquetFile.iter_batches

    def counted(*args, **options):
        for batch in read(*args, **options):
            decoded.append(batch.num_rows)
            yield batch

    monkeypatch.setattr(pq.ParquetFile, "iter_batches", counted)
    for begin, end in ((1000, 1100), (1085, 1093), (1090, 1100), (1000, 1001)):
        decoded.clear()
        got = [r for batch in reader.read(topic.FileRange(0, "part.parquet", 1000, begin, end)) for r in batch.to_pylist()]
        assert [(r["position"], r["value"], r["partition"]) for r in got] == [(n, str(n - 1000), 0) for n in range(begin, end)]
        assert sum(decoded) <= end - begin + 20


def test_one_query_drains_all_micro_batches(spark, tmp_path):
    path = str(tmp_path / "topic")
    reader = Reader(spark, tmp_path, "drained", bound=40)
    for low, high, batches in ((0, 100, 3), (100, 150, 5), (150, 150, 5)):
        if high > low:
            topic.publish(rows_of(spark, low, high), path, 3, ["id"])
        sinks.drain_parquet(topic.read_topic(spark, path, 3, "drained", "earliest", 40), reader.out, reader.checkpoint)
        assert reader.values() == list(range(high))
        assert len(glob.glob(f"{reader.checkpoint}/commits/[0-9]*")) == batches
