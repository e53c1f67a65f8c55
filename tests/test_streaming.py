from __future__ import annotations

from datetime import datetime, timedelta
from functools import partial

import pytest
from pyspark.sql import functions as F

from meterline.registry import streams
from meterline.streaming import messages, sinks, windows
from meterline.streaming.sessions import stream_session

START = datetime(2020, 1, 1)
KEYS = ["event_hour", "test_data"]


def event_messages(spark, *events):
    df = spark.createDataFrame([(START + timedelta(seconds=s), k) for s, k in events], "ts timestamp, test_data int")
    shaped = df.withColumn("event_timestamp", (F.unix_micros("ts") / 1000).cast("double"))
    return messages.to_messages(shaped, ["test_data", "event_timestamp"])


class Inbox:
    def __init__(self, spark, tmp_path):
        self.spark, self.stream = spark, stream_session(spark, 2)
        self.inbox, self.out, self.checkpoint = (str(tmp_path / part) for part in ("in", "out", "cp"))

    def run(self, batch, sink, job, files_per_trigger=None):
        messages.write_message_files(batch, self.inbox)
        inbox = messages.read_message_files(self.stream, self.inbox, files_per_trigger)
        query = sink(job(inbox), self.out, self.checkpoint, available_now=True)
        query.awaitTermination()
        return query


def tumble(inbox):
    events = windows.with_event_time(messages.parse_events(inbox), "event_time", "1 second")
    return windows.tumbling_hits(events, "event_time", "test_data")


def test_messages_round_trip(spark):
    row = messages.parse_events(event_messages(spark, (61.5, 7))).first()
    assert (row.test_data, row.event_time) == (7, START + timedelta(seconds=61.5))
    text = '{"lpep_dropoff_datetime":"2019-10-01 00:26:02","PULocationID":112,"passenger_count":null}'
    trip = messages.parse_trips(spark.createDataFrame([(text,), ("not json",)], "value string")).collect()
    assert (trip[0].PULocationID, trip[0].passenger_count, trip[0].dropoff_time) == (112, None, datetime(2019, 10, 1, 0, 26, 2))
    assert trip[1].PULocationID is None and trip[1].dropoff_time is None


def test_upserts_replace_earlier_counts_and_survive_replay(spark, rows, tmp_path):
    box = Inbox(spark, tmp_path)
    first, second = event_messages(spark, (10, 1), (20, 1), (30, 2)), event_messages(spark, (40, 1), (70, 1))
    for batch in (first, second):
        box.run(batch, sinks.upsert_parquet, tumble)
    wanted = [(START, 1, 3), (START, 2, 1), (START + timedelta(minutes=1), 1, 1)]
    assert rows(sinks.current_rows(spark, box.out, KEYS), *KEYS, "num_hits") == wanted
    assert rows(tumble(first.unionByName(second))) == wanted
    # A fresh checkpoint replays everything into the same folders.
    box.checkpoint += "-again"
    box.run(event_messages(spark), sinks.upsert_parquet, tumble)
    sinks.compact(spark, box.out, KEYS)
    assert len(sinks.batch_numbers(spark, box.out)) == 1
    assert rows(sinks.current_rows(spark, box.out, KEYS), *KEYS, "num_hits") == wanted


def test_append_waits_for_the_watermark_and_resumes(spark, rows, tmp_path):
    box = Inbox(spark, tmp_path)
    box.run(event_messages(spark, (10, 1), (70, 1)), sinks.append_parquet, tumble)
    closed = spark.read.schema("event_hour timestamp, test_data bigint, num_hits bigint").parquet(box.out)
    assert rows(closed) == [(START, 1, 1)]
    box.run(event_messages(spark, (600, 1)), sinks.append_parquet, tumble)
    assert spark.read.parquet(box.out).count() == 2


def test_late_rows_are_dropped_and_counted(spark, rows, tmp_path):
    box = Inbox(spark, tmp_path)
    box.run(event_messages(spark, (600, 1)), sinks.upsert_parquet, tumble)
    counter = sinks.LateRows()
    box.stream.streams.addListener(counter)
    late = box.run(event_messages(spark, (10, 1), (20, 2)), sinks.upsert_parquet, tumble)
    assert counter.of(late) == 2
    on_time = box.run(event_messages(spark, (601, 1)), sinks.upsert_parquet, tumble)
    assert counter.of(on_time) == 0
    box.stream.streams.removeListener(counter)
    assert rows(sinks.current_rows(spark, box.out, KEYS), "num_hits") == [(2,)]


def test_late_rows_of_more_batches_than_a_query_remembers(spark, tmp_path):
    box = Inbox(spark, tmp_path)
    box.stream.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    box.run(event_messages(spark, (600, 1)), sinks.upsert_parquet, tumble)
    for k in range(6):
        messages.write_message_files(event_messages(spark, (k, k)).coalesce(1), box.inbox)
    counter = sinks.LateRows()
    box.stream.streams.addListener(counter)
    query = box.run(event_messages(spark), sinks.upsert_parquet, tumble, files_per_trigger=1)
    assert counter.of(query) == 6 and len(query.recentProgress) <= 2
    box.stream.streams.removeListener(counter)


def test_compaction_keeps_reading_independent_of_batches(spark, rows, tmp_path):
    box = Inbox(spark, tmp_path)
    sink = partial(sinks.upsert_parquet, compact_every=3, keys=KEYS)
    for k in range(7):
        box.run(event_messages(spark, (10, 1), (10 + k, 2)), sink, tumble)
    # Every run has a second batch that only moves the watermark: fourteen in all.
    assert sinks.batch_numbers(spark, box.out) == ["11.5", "12", "13"]
    assert rows(sinks.current_rows(spark, box.out, KEYS), "test_data", "num_hits") == [(1, 7), (2, 7)]


def test_missing_keys_have_windows(spark, rows, tmp_path):
    box = Inbox(spark, tmp_path)
    box.run(event_messages(spark, (10, None), (20, None), (30, -1)), sinks.append_parquet, tumble)
    box.run(event_messages(spark, (6000, 0)), sinks.append_parquet, tumble)
    closed = spark.read.parquet(box.out).filter(F.col("event_hour") < START + timedelta(seconds=6000))
    assert rows(closed, "test_data", "num_hits") == [(-1, 1), (None, 2)]


def test_fan_out_feeds_every_sink(spark, tmp_path):
    box = Inbox(spark, tmp_path)

    def fan(stream, out, checkpoint, available_now):
        sinks_ = [
            lambda batch, n, part=part: batch.write.mode("overwrite").parquet(f"{out}-{part}/batch={n}")
            for part in ("a", "b")
        ]
        return sinks.fan_out(stream, sinks_, checkpoint, available_now)

    box.run(event_messages(spark, (1, 1), (2, 2)), fan, messages.parse_events)
    assert [spark.read.parquet(f"{box.out}-{part}").count() for part in ("a", "b")] == [2, 2]


def test_print_sink(spark, tmp_path):
    box = Inbox(spark, tmp_path)

    def show(stream, out, checkpoint, available_now):
        return sinks.print_rows(stream, checkpoint, available_now)

    assert box.run(event_messages(spark, (1, 1)), show, messages.parse_events).exception() is None


def test_stream_sessions_equal_batch_sessions(spark, rows, tmp_path):
    def trips(*data):
        df = spark.createDataFrame(
            [((START + timedelta(seconds=s)).strftime("%Y-%m-%d %H:%M:%S"), p, d) for s, p, d in data],
            "lpep_dropoff_datetime string, PULocationID int, DOLocationID int",
        )
        return messages.to_messages(df, df.columns)

    def job(inbox):
        events = windows.with_event_time(messages.parse_trips(inbox), "dropoff_time", "5 seconds")
        return windows.session_streaks(events, "dropoff_time", ["PULocationID", "DOLocationID"])

    box = Inbox(spark, tmp_path)
    real = trips((0, 95, 95), (300, 95, 95), (601, 95, 95), (10, 1, 2))
    box.run(real, sinks.append_parquet, job)
    box.run(trips((100_000, -1, -1)), sinks.append_parquet, job)
    got = spark.read.schema(job(real).schema).parquet(box.out).filter("PULocationID > 0")
    assert rows(got) == rows(job(real))
    assert rows(got, "PULocationID", "streak_length") == [(1, 1), (95, 1), (95, 2)]


# Dates far apart, of which every file of a replay has some, and one behind the year 2200.
STRAYS = [(START.replace(year=year) + timedelta(hours=5 * k), k % 3) for k in range(40) for year in (2009, 2098)]
STRAYS += [(datetime(2250, 1, 1), 1), (datetime(1970, 1, 1, 0, 0, 0, 5000), 2)]


@pytest.mark.parametrize("name, width", [("stream_watermark", "1 hour"), ("stream_tumble", "1 minute"), ("stream_upsert_tumble", "1 hour")])
def test_replays_keep_stray_dates(spark, rows, monkeypatch, name, width):
    events = spark.createDataFrame(STRAYS, "ts timestamp, user_id long")
    monkeypatch.setattr(streams.roles, "events", lambda *_: events)
    want = windows.tumbling_hits(messages.parse_events(streams.as_event_messages(events)), "event_time", "test_data", width)
    columns = ("event_hour", "test_data", "num_hits")
    assert rows(getattr(streams, name)(spark, ""), *columns) == rows(want, *columns)


def test_session_replay_keeps_stray_dates(spark, rows, monkeypatch):
    trips = spark.createDataFrame([(str(ts.replace(microsecond=0)), k, k) for ts, k in STRAYS], "lpep_dropoff_datetime string, PULocationID int, DOLocationID int")
    batch = messages.to_messages(trips, trips.columns)
    monkeypatch.setattr(streams, "trip_messages", lambda *_: batch)
    want = windows.session_streaks(messages.parse_trips(batch), "dropoff_time", ["PULocationID", "DOLocationID"], "1 day")
    assert rows(streams.stream_session_query(spark, "")) == rows(want)


def test_histories_that_a_stream_would_cut_are_refused(spark):
    early = spark.createDataFrame([(datetime(1969, 12, 31, 23, 59, 59),), (START,)], "ts timestamp")
    with pytest.raises(ValueError, match="starts at 1970"):
        streams.History.of(early, "ts")
    with pytest.raises(ValueError, match="too far apart"):
        streams._trip_sentinel(spark, streams.History(0, 200_000_000_000))
