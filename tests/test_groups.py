from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.operators import percentiles, sessions
from meterline.operators.windows import at_dense_rank, keep_first
from meterline.streaming.windows import session_streaks

NAMED = {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p97": 0.97, "p100": 1.0}


def percentile_rows(df, keys):
    result = percentiles.exact_percentiles(df, keys, "v", NAMED)
    return {tuple(r[k] for k in keys): [r[n] for n in NAMED] for r in result.collect()}


@pytest.mark.parametrize("slices", [4, 256])
def test_percentiles_match_brute_force(spark, monkeypatch, slices):
    monkeypatch.setattr(percentiles, "SLICES", slices)
    draw = random.Random(3)
    # One group holds most rows, one repeats a single value, one has one row, one key is NULL.
    data = [("hot", round(draw.expovariate(0.1), 2)) for _ in range(3000)]
    data += [("same", 7.0)] * 500 + [("one", -1.5)] + [(None, float(draw.randint(-5, 5))) for _ in range(400)]
    df = spark.createDataFrame([*data, ("hot", None)], "g string, v double")
    got = percentile_rows(df, ["g"])
    assert set(got) == {("hot",), ("same",), ("one",), (None,)}
    for (group,), points in got.items():
        values = [v for g, v in data if g == group]
        assert points == pytest.approx(list(np.quantile(values, list(NAMED.values()))))


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert percentile_rows(df, ["g"]) == {}


def test_percentiles_without_keys(spark):
    df = spark.createDataFrame([(float(k),) for k in range(101)], "v double")
    assert tuple(percentiles.exact_percentiles(df, [], "v", {"p50": 0.5, "p90": 0.9}).first()) == (50.0, 90.0)


def test_kept_row_does_not_depend_on_input_order(spark, rows):
    data = [(1, "b", None), (1, "a", 5), (1, "a", None), (2, "z", 1)]
    for seed in range(3):
        shuffled = random.Random(seed).sample(data, len(data))
        df = spark.createDataFrame(shuffled, "k int, n string, v int").repartition(3)
        assert rows(keep_first(df, ["k"])) == [(1, "a", None), (2, "z", 1)]


def test_dense_rank_keeps_ties(spark, rows):
    df = spark.createDataFrame([("a", 9, 1), ("a", 9, 2), ("a", 5, 3), ("a", 5, 4), ("a", 1, 5)], "k string, v int, id int")
    assert rows(at_dense_rank(df, ["k"], F.col("v").desc(), 2), "id") == [(3,), (4,)]


START = datetime(2020, 1, 1)


def brute_sessions(times, gap):
    spans = []
    for t in sorted(times):
        if spans and t <= spans[-1][1] + gap:
            spans[-1][1:] = [t, spans[-1][2] + 1]
        else:
            spans.append([t, t, 1])
    return [(a, b + gap, n) for a, b, n in spans]


def random_events(seed, count=400, keys=3, spread=40_000):
    draw = random.Random(seed)
    return [
        (START + timedelta(seconds=draw.randint(-spread, spread), microseconds=draw.choice([0, 1, 999_999])), draw.randint(1, keys))
        for _ in range(count)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_sessions_match_brute_force_and_session_window(spark, rows, seed):
    data = random_events(seed)
    df = spark.createDataFrame(data, "ts timestamp, k int")
    got = rows(sessions.sessions(df, "ts", 300, ["k"]), "k", "session_start", "session_end", "n")
    wanted = [
        (k, *span) for k in (1, 2, 3)
        for span in brute_sessions([t for t, key in data if key == k], timedelta(seconds=300))
    ]
    wanted.sort(key=repr)
    assert got == wanted
    windowed = session_streaks(df, "ts", ["k"], "300 seconds", "n")
    assert rows(windowed, "k", "session_start", "session_end", "n") == wanted


@pytest.mark.parametrize("chunk", [1, 3, 4096])
def test_global_sessions_match_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(sessions, "CELLS_PER_CHUNK", chunk)
    data = random_events(11, spread=30_000)
    df = spark.createDataFrame(data, "ts timestamp, k int")
    got = sorted(tuple(r) for r in sessions.global_session_pairs(df, "ts", 300, ["k"]).collect())
    wanted = []
    for first, end, _ in brute_sessions([t for t, _ in data], timedelta(seconds=300)):
        for key in (1, 2, 3):
            count = sum(first <= t < end and k == key for t, k in data)
            if count:
                wanted.append((first, end, key, count))
    assert got == sorted(wanted)


def test_events_exactly_one_gap_apart_share_a_session(spark):
    gap = timedelta(seconds=300)
    touching = [(START,), (START + gap,)]
    apart = [(START,), (START + gap + timedelta(microseconds=1),)]
    for data, wanted in ((touching, 1), (apart, 2)):
        df = spark.createDataFrame([(*row, 1) for row in data], "ts timestamp, k int")
        assert sessions.sessions(df, "ts", 300, ["k"]).count() == wanted
        assert session_streaks(df, "ts", ["k"]).count() == wanted


def test_longest_streak(spark):
    df = spark.createDataFrame([(1, 2), (1, 5), (2, 3)], "k int, streak_length int")
    assert [tuple(r) for r in sessions.longest_streaks(df, ["k"]).collect()] == [(1, 5), (2, 3)]


def test_rows_ordered_as_a_whole_are_bounded_by_the_time_span(spark):
    """Sessions over all events order one row per chunk of cells: span / (gap * chunk), whatever the events."""
    gap, span = 60, 10 * 86_400
    times = random.Random(4)
    for events in (2_000, 20_000):
        df = spark.createDataFrame([(START + timedelta(seconds=times.uniform(0, span)),) for _ in range(events)], "t timestamp")
        chunks = sessions._cells(df, "t", gap, []).select(F.floor(F.col("_cell") / sessions.CELLS_PER_CHUNK)).distinct().count()
        assert chunks <= span / (gap * sessions.CELLS_PER_CHUNK) + 2
