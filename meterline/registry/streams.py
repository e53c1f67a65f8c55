"""Streaming queries, replayed from message files to completion."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterline.functions.temporal import EVENT_TIME_FORMAT, parse_event_time
from meterline.registry import checks
from meterline.registry.book import query
from meterline.registry.scans import trip_messages
from meterline.sources import roles
from meterline.streaming import global_sessions, late, messages, sinks, windows
from meterline.streaming.sessions import stream_session
from meterline.workspace import materialize, new_dir

# Key of a message far behind all others: it moves the watermark past every real window.
# Windows are told from the sentinel's by their time: real keys may be NULL or hold any value.
SENTINEL_KEY = -1
# A real window or session ends less than this after its last event.
LONGEST_WINDOW = 2 * 86_400
# Seconds from 1970 to the last that the text of a trip's time can name.
LAST_TEXT_SECOND = 253_402_300_799


@dataclass(frozen=True)
class History:
    """First and last event time of a history, in whole seconds since 1970.

    A sentinel behind the last event by more than its span closes what is left open.
    """

    first: int
    last: int

    @classmethod
    def of(cls, rows: DataFrame, ts: str) -> History:
        seconds = rows.agg(F.unix_seconds(F.min(ts)), F.unix_seconds(F.max(ts))).first()
        history = cls(*(second or 0 for second in seconds))
        if history.first < 0:
            raise ValueError("a watermark starts at 1970: a stream drops what is earlier as late")
        return history

    @property
    def delay_seconds(self) -> int:
        return self.last - self.first + 2

    @property
    def sentinel_second(self) -> int:
        return self.last + self.delay_seconds + LONGEST_WINDOW

    @property
    def sentinel(self) -> Column:
        return F.timestamp_seconds(F.lit(self.sentinel_second))

    @property
    def end(self) -> Column:
        """Every real window starts before it, and the sentinel's does not."""
        return F.timestamp_seconds(F.lit(self.last + 1))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events as messages: user as ``test_data``, time in (float) epoch milliseconds."""
    return as_event_messages(roles.events(spark, sf_dir))


def as_event_messages(events: DataFrame) -> DataFrame:
    shaped = events.select(
        F.col("user_id").alias("test_data"),
        (F.unix_micros("ts") / 1000).cast("double").alias("event_timestamp"),
    )
    return messages.to_messages(shaped, ["test_data", "event_timestamp"])


def _event_sentinel(spark: SparkSession, history: History) -> DataFrame:
    one = spark.range(1).select(F.lit(SENTINEL_KEY).cast("bigint").alias("user_id"), history.sentinel.alias("ts"))
    return as_event_messages(one)


def _trip_sentinel(spark: SparkSession, history: History) -> DataFrame:
    if history.sentinel_second > LAST_TEXT_SECOND:
        raise ValueError("trips lie too far apart in time: no message of a trip can close their last sessions")
    one = spark.range(1).select(
        F.date_format(history.sentinel, EVENT_TIME_FORMAT).alias("lpep_dropoff_datetime"),
        F.lit(SENTINEL_KEY).alias("PULocationID"), F.lit(SENTINEL_KEY).alias("DOLocationID"),
    )
    return messages.to_messages(one, one.columns)


# A replayed history is delivered in this many files, of which a micro-batch takes some.
DELIVERY_FILES = 6
REPLAY_FILES_PER_TRIGGER = 2


class Replay:
    """A folder of messages with a checkpoint and a sink, fed and drained step by step."""

    def __init__(self, spark: SparkSession, label: str, files_per_trigger: int | None = REPLAY_FILES_PER_TRIGGER):
        self.spark, self.stream, self.files_per_trigger = spark, stream_session(spark), files_per_trigger
        self.inbox, self.checkpoint, self.out = (new_dir(spark, f"{label}-{part}") for part in ("in", "cp", "out"))

    def step(self, batch: DataFrame, job, sink=sinks.append_parquet):
        """Add messages, run ``job`` over what is new, and return the finished query."""
        messages.write_message_files(batch.repartition(DELIVERY_FILES), self.inbox)
        inbox = messages.read_message_files(self.stream, self.inbox, self.files_per_trigger)
        started = sink(job(inbox), self.out, self.checkpoint, available_now=True)
        started.awaitTermination()
        return started

    def rows(self, schema_of: DataFrame) -> DataFrame:
        return self.spark.read.schema(schema_of.schema).parquet(self.out)


@query(
    "stream_passthrough",
    """SELECT user_id AS test_data, date_trunc('millisecond', ts)::TIMESTAMP AS event_timestamp
       FROM events""",
)
def stream_passthrough(spark, sf_dir):
    def job(inbox):
        return messages.parse_events(inbox).select("test_data", F.col("event_time").alias("event_timestamp"))

    batch = event_messages(spark, sf_dir)
    replay = Replay(spark, "passthrough")
    replay.step(batch, job)
    return replay.rows(job(batch))


# A history is replayed as this many deliveries in order of time, each one micro-batch.
DELIVERIES = 3


def _in_order(rows: DataFrame, ts: str = "ts", parts: int = DELIVERIES) -> list[DataFrame]:
    """Deliveries that follow each other in time, of equal spans; rows without a time come first.

    The watermark can then trail by seconds, and what it has passed leaves the state.
    """
    at = F.unix_micros(ts)
    low, high = rows.agg(F.min(at), F.max(at)).first()
    if low is None:
        return [rows]
    cuts = [low + (high - low) * k // parts for k in range(1, parts)]
    number = F.lit(0)
    for cut in cuts:
        number = number + F.coalesce(at >= cut, F.lit(False)).cast("int")
    return [rows.filter(number == k) for k in range(parts)]


def _tumble_sql(width: str) -> str:
    return f"""SELECT date_trunc('{width}', ts)::TIMESTAMP AS event_hour, user_id AS test_data,
        count(*) AS num_hits FROM events GROUP BY 1, 2"""


def _tumble(width: str, delay: str):
    def job(inbox):
        events = windows.with_event_time(messages.parse_events(inbox), "event_time", delay)
        return windows.tumbling_hits(events, "event_time", "test_data", width)

    return job


@query("stream_watermark", _tumble_sql("hour"))
def stream_watermark(spark, sf_dir):
    """Finished windows only, a second behind; every delivery resumes from the checkpoint."""
    events = roles.events(spark, sf_dir)
    history = History.of(events, "ts")
    batch, job = as_event_messages(events), _tumble("1 hour", "1 second")
    replay = Replay(spark, "watermark", files_per_trigger=None)
    for part in _in_order(events):
        replay.step(as_event_messages(part), job)
    replay.step(_event_sentinel(spark, history), job)
    return replay.rows(job(batch)).filter(F.col("event_hour") < history.end)


@query("stream_tumble", _tumble_sql("minute"))
def stream_tumble(spark, sf_dir):
    events = roles.events(spark, sf_dir)
    replay = Replay(spark, "tumble", files_per_trigger=None)
    for part in _in_order(events):
        replay.step(as_event_messages(part), _tumble("1 minute", "1 second"), sinks.upsert_parquet)
    return sinks.current_rows(spark, replay.out, ["event_hour", "test_data"])


@query("stream_upsert_tumble", _tumble_sql("hour"))
def stream_upsert_tumble(spark, sf_dir):
    """Three deliveries cut inside windows, so that later ones replace earlier counts."""
    events = roles.events(spark, sf_dir)
    replay, job = Replay(spark, "upsert", files_per_trigger=None), _tumble("1 hour", "1 second")
    sink = partial(sinks.upsert_parquet, compact_every=3, keys=["event_hour", "test_data"])
    for part in _in_order(events):
        replay.step(as_event_messages(part), job, sink)
    return sinks.current_rows(spark, replay.out, ["event_hour", "test_data"])


@query(
    "stream_session",
    f"""WITH {checks.TRIPS}, marked AS (SELECT *, CASE WHEN dropoff_datetime > lag(dropoff_datetime) OVER w
          + INTERVAL 1 DAY OR lag(dropoff_datetime) OVER w IS NULL THEN 1 ELSE 0 END AS opens FROM trips
          WINDOW w AS (PARTITION BY pulocationid, dolocationid ORDER BY dropoff_datetime)),
        numbered AS (SELECT *, sum(opens) OVER (PARTITION BY pulocationid, dolocationid ORDER BY dropoff_datetime
          ROWS UNBOUNDED PRECEDING) AS session FROM marked)
        SELECT pulocationid AS "PULocationID", dolocationid AS "DOLocationID", count(*) AS streak_length,
          min(dropoff_datetime) AS session_start, max(dropoff_datetime) + INTERVAL 1 DAY AS session_end
        FROM numbered GROUP BY 1, 2, session""",
)
def stream_session_query(spark, sf_dir):
    """Closed sessions per pair; trips of a pair are spread over years, so the gap is a day."""
    dropoff = parse_event_time(F.get_json_object("value", "$.lpep_dropoff_datetime"))
    batch = materialize(trip_messages(spark, sf_dir).withColumn("ts", dropoff), "session-messages", codec="zstd")
    history = History.of(batch, "ts")

    def job(inbox):
        trips = windows.with_event_time(messages.parse_trips(inbox), "dropoff_time", "5 seconds")
        return windows.session_streaks(trips, "dropoff_time", ["PULocationID", "DOLocationID"], "1 day")

    replay = Replay(spark, "session", files_per_trigger=None)
    for part in _in_order(batch):
        replay.step(part, job)
    replay.step(_trip_sentinel(spark, history), job)
    return replay.rows(job(batch)).filter(F.col("session_start") < history.end)


@query(
    "late_event_audit",
    """WITH cut AS (SELECT date_trunc('hour', make_timestamp((epoch_us(min(ts)) + epoch_us(max(ts))) // 2)) AS cut_at
         FROM events)
       SELECT count(*) AS events_sent, count_if(ts >= cut_at) AS events_counted, count_if(ts < cut_at) AS events_late,
         count(DISTINCT CASE WHEN ts < cut_at THEN (date_trunc('hour', ts), user_id) END) AS windows_dropped
       FROM events, cut""",
)
def late_event_audit(spark, sf_dir):
    """The later half is delivered first, so the earlier half comes behind the watermark.

    ``windows_dropped`` is what the stream itself reports: late rows are counted
    after they were added up by window and key. Each half is one micro-batch.
    """
    events = roles.events(spark, sf_dir)
    middle = F.timestamp_micros(((F.unix_micros(F.min("ts")) + F.unix_micros(F.max("ts"))) / 2).cast("bigint"))
    cut = events.agg(F.date_trunc("hour", middle).alias("at")).scalar()
    replay, job = Replay(spark, "late", files_per_trigger=None), _tumble("1 hour", "1 second")
    dropped = sinks.LateRows()
    replay.stream.streams.addListener(dropped)
    try:
        replay.step(as_event_messages(events.filter(F.col("ts") >= cut)), job, sinks.upsert_parquet)
        late = replay.step(as_event_messages(events.filter(F.col("ts") < cut)), job, sinks.upsert_parquet)
        windows_dropped = dropped.of(late)
    finally:
        replay.stream.streams.removeListener(dropped)
    counted = sinks.current_rows(spark, replay.out, ["event_hour", "test_data"]).agg(
        F.sum("num_hits").alias("counted")
    )
    return events.agg(F.count("*").alias("events_sent")).select(
        "events_sent",
        counted.scalar().alias("events_counted"),
        (F.col("events_sent") - counted.scalar()).alias("events_late"),
        F.lit(windows_dropped).cast("bigint").alias("windows_dropped"),
    )


@query(
    "stream_global_sessions",
    """WITH moments AS (SELECT user_id, date_trunc('millisecond', ts)::TIMESTAMP AS ts FROM events
        ), marked AS (SELECT *, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 5 MINUTE THEN 0 ELSE 1 END AS opens FROM moments WINDOW w AS (ORDER BY ts)
        ), numbered AS (SELECT *, sum(opens) OVER (ORDER BY ts) AS session FROM marked
        ), spans AS (SELECT session, min(ts) AS session_start, max(ts) + INTERVAL 5 MINUTE AS session_end FROM numbered GROUP BY 1)
        SELECT session_start, session_end, user_id AS test_data, count(*) AS trip_count FROM numbered JOIN spans USING (session) GROUP BY 1, 2, 3""",
)
def stream_global_sessions(spark, sf_dir):
    """Sessions over all users together, from a stream with a watermark of 5 seconds; state is kept per 6 hours."""
    events = roles.events(spark, sf_dir)
    history = History.of(events, "ts")

    def job(inbox):
        timed = windows.with_event_time(messages.parse_events(inbox), "event_time", "5 seconds")
        return global_sessions.session_pieces(timed, "event_time", 5 * 60, 6 * 3600, ["test_data"])

    def sink(stream, out, checkpoint, available_now):
        return sinks.each_batch(stream, global_sessions.link_closed(out, 5 * 60, ["test_data"]), checkpoint, available_now)

    replay = Replay(spark, "global-sessions", files_per_trigger=None)
    for part in _in_order(events):
        replay.step(as_event_messages(part), job, sink)
    replay.step(_event_sentinel(spark, history), job, sink)
    return global_sessions.closed_sessions(spark, replay.out)


# Every tenth event comes one delivery late; a row may be five days and five seconds behind.
LATENESS_SECONDS, LATE_DELAY_SECONDS = 5 * 86_400, 5
_DELIVERED = f"""WITH span AS (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM events
    ), sent AS (SELECT user_id, date_trunc('millisecond', ts)::TIMESTAMP AS ts,
        least(3 * (epoch_us(ts) - low) // (high - low + 1), 2) + (event_id % 10 = 0)::INTEGER AS delivery FROM events, span
    ), marks AS (SELECT d.delivery, max(s.ts) AS mark FROM (SELECT DISTINCT delivery FROM sent) d LEFT JOIN sent s ON s.delivery < d.delivery GROUP BY 1
    ), judged AS (SELECT sent.*, mark, coalesce(ts < mark - INTERVAL {LATENESS_SECONDS + LATE_DELAY_SECONDS} SECOND, false) AS late FROM sent JOIN marks USING (delivery))"""


def _with_late_rows(spark, sf_dir) -> Replay:
    events = roles.events(spark, sf_dir)
    low, high = events.agg(F.unix_micros(F.min("ts")), F.unix_micros(F.max("ts"))).first()
    part = F.expr(f"least(3 * (unix_micros(ts) - {low or 0}L) div {(high or 0) - (low or 0) + 1}L, 2L)") + (F.col("event_id") % 10 == 0).cast("int")
    numbered = events.withColumn("delivery", part)

    def job(inbox):
        return messages.parse_events(inbox).select("test_data", F.col("event_time").alias("event_timestamp"))

    def sink(stream, out, checkpoint, available_now):
        keep = late.keep_late(out, "event_timestamp", "test_data", "1 hour", LATE_DELAY_SECONDS, LATENESS_SECONDS)
        return sinks.each_batch(stream, keep, checkpoint, available_now)

    replay = Replay(spark, "late-rows", files_per_trigger=None)
    for number in range(4):
        replay.step(as_event_messages(numbered.filter(F.col("delivery") == number)), job, sink)
    return replay


@query("stream_late_rows", f"{_DELIVERED} SELECT user_id AS test_data, ts AS event_timestamp, mark FROM judged WHERE late")
def stream_late_rows(spark, sf_dir):
    """The rows that came too late, each kept with the mark it missed."""
    replay = _with_late_rows(spark, sf_dir)
    return late.late_rows(spark, replay.out).drop("batch")


@query(
    "stream_corrected_windows",
    f"{_DELIVERED} SELECT date_trunc('hour', ts) AS event_hour, user_id AS test_data, count(*) AS num_hits FROM judged WHERE NOT late GROUP BY 1, 2",
)
def stream_corrected_windows(spark, sf_dir):
    """Windows that rows within the allowed lateness have corrected."""
    replay = _with_late_rows(spark, sf_dir)
    return late.corrected_windows(spark, replay.out, ["event_hour", "test_data"])
