from __future__ import annotations

import random
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from meterline.operators import sessions
from meterline.streaming import global_sessions, late, sinks, windows
from meterline.streaming.sessions import stream_session

START = datetime(2020, 1, 1)


def frame(spark, moments):
    return spark.createDataFrame([(None if s is None else START + timedelta(seconds=s), k) for s, k in moments], "ts timestamp, pair int")


def deliver(spark, tmp_path, parts, job, store):
    """Each part as one micro-batch of a query that starts anew from the checkpoint."""
    stream, inbox, checkpoint = stream_session(spark, 2), str(tmp_path / "in"), str(tmp_path / "cp")
    reports = []
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(inbox)
        rows = stream.readStream.schema("ts timestamp, pair int").parquet(inbox)
        query = sinks.each_batch(job(rows), store, checkpoint, available_now=True)
        query.awaitTermination()
        reports.append(query.recentProgress)
    return reports


def test_sessions_over_all_keys_equal_the_batch_form(spark, tmp_path, rows):
    rnd = random.Random(4)
    # One session over many ranges, sessions on both sides of a border, quiet stretches, equal times, no time.
    moments = [(s, rnd.randrange(3)) for s in range(0, 9000, 50)]
    moments += [(20_000 + rnd.randrange(20_000), rnd.choice([1, None])) for _ in range(200)]
    moments += [(43_199, 1), (43_200, 2), (43_260, 2), (46_799, 1), (46_860, 1), (46_860, 1), (None, 5)]
    moments.sort(key=lambda x: (x[0] is None, x[0]))
    thirds = [moments[:150], moments[150:300], moments[300:], [(400_000, 9)]]

    def job(stream):
        return global_sessions.session_pieces(stream.withWatermark("ts", "5 seconds"), "ts", 60, 3600, ["pair"])

    out = str(tmp_path / "out")
    reports = deliver(spark, tmp_path, [frame(spark, part) for part in thirds], job, global_sessions.link_closed(out, 60, ["pair"]))
    got = rows(global_sessions.closed_sessions(spark, out).select("session_start", "session_end", "pair", "trip_count"))
    assert got == rows(sessions.global_session_pairs(frame(spark, moments), "ts", 60, ["pair"]).select("session_start", "session_end", "pair", "trip_count"))
    # What is closed leaves the state: after each delivery only the newest ranges are held.
    assert all(report[-1].stateOperators[0].numRowsTotal <= 4 for report in reports)


def test_pieces_of_one_range():
    def cells(*lines):
        return pd.DataFrame(lines, columns=["side", "cell", "key", "first", "last", "n"])

    found = global_sessions.pieces(cells((0, 10, "a", 100, 105, 2), (0, 11, "a", 112, 112, 1), (0, 13, "b", 130, 130, 1),
                                         (-1, 9, "a", 92, 94, 1), (1, 14, "a", 140, 141, 3)), 10, ["key"])
    assert found[["piece", "first", "last", "goes_on_before", "goes_on_behind", "key", "n"]].values.tolist() == [
        [0, 100, 112, True, False, "a", 3], [1, 130, 130, False, True, "b", 1]]
    assert not len(global_sessions.pieces(cells((-1, 9, "a", 92, 94, 1)), 10, ["key"]))


def test_late_rows_are_kept_and_allowed_ones_correct_windows(spark, tmp_path, rows):
    parts = [
        [(0, 1), (30, 1), (4000, 2)],
        [(3990, 2), (500, 1), (399, 1), (401, 1), (None, 7), (8000, 1)],  # the mark is 4000: rows before 400 are late
        [(4399, 3), (4400, 3)],
    ]
    out = str(tmp_path / "out")
    store = late.keep_late(out, "ts", "pair", "1 hour", 100, 3500)
    deliver(spark, tmp_path, [frame(spark, part) for part in parts], lambda stream: stream, store)
    at = lambda s: START + timedelta(seconds=s)
    kept = rows(late.late_rows(spark, out), "ts", "pair", "mark")
    assert sorted(kept, key=repr) == sorted([(at(399), 1, at(4000)), (None, 7, at(4000)), (at(4399), 3, at(8000))], key=repr)
    counted = rows(late.corrected_windows(spark, out, ["event_hour", "pair"]), "event_hour", "pair", "num_hits")
    whole = frame(spark, [x for part in parts for x in part if x not in ((399, 1), (None, 7), (4399, 3))])
    assert counted == rows(windows.tumbling_hits(whole, "ts", "pair", "1 hour"), "event_hour", "pair", "num_hits")
    assert sum(x[2] for x in counted) + len(kept) == sum(map(len, parts))
    # A replayed micro-batch overwrites what it left.
    store(frame(spark, parts[1]), 1)
    assert rows(late.late_rows(spark, out), "ts", "pair", "mark") == kept
    assert rows(late.corrected_windows(spark, out, ["event_hour", "pair"]), "event_hour", "pair", "num_hits") == counted
    assert late.late_rows(spark, out).filter(F.col("mark").isNull()).count() == 0


def test_state_stays_flat_over_ten_deliveries(spark, tmp_path, rows):
    """Windows and sessions behind a short watermark leave the state, and none is lost."""
    moments = [(10_000 * part + 400 * k, k % 5) for part in range(10) for k in range(25)]
    parts = [frame(spark, moments[25 * k:25 * k + 25]) for k in range(10)] + [frame(spark, [(1_000_000, -1)])]
    for name, job, columns in (
        ("tumble", lambda df: windows.tumbling_hits(windows.with_event_time(df, "ts", "1 second"), "ts", "pair", "1 hour"), ("event_hour", "pair", "num_hits")),
        ("session", lambda df: windows.session_streaks(windows.with_event_time(df, "ts", "5 seconds"), "ts", ["pair"], "30 minutes"),
         ("session_start", "session_end", "pair", "streak_length")),
    ):
        folder = tmp_path / name
        folder.mkdir()
        out = str(folder / "out")
        store = lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/batch={number}")  # noqa: B023, E731
        reports = deliver(spark, folder, parts, job, store)
        held = [report[-1].stateOperators[0].numRowsTotal for report in reports[:-1]]
        assert max(held) <= 2 * held[0] and held[0] > 0
        got = spark.read.parquet(out).filter("pair >= 0")
        assert rows(got, *columns) == rows(job(frame(spark, moments)), *columns)
