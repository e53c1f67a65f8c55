"""Table statements, joins and SQL forms the models do not use, each over the given tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.functions.text import digits_only
from meterline.operators import relational, tables
from meterline.registry import checks
from meterline.registry.book import query
from meterline.registry.checks import money
from meterline.registry.models import as_double, zones
from meterline.registry.scans import SERVICES, detached, monthly_csv
from meterline.registry.streams import Replay, as_event_messages
from meterline.sources import files, roles
from meterline.streaming import messages, sinks
from meterline.workspace import new_dir

# Rows per batch a batched read hands over at most.
BATCH_ROWS = 100_000


def _new_table(spark: SparkSession, label: str) -> tuple[str, str]:
    """Name and folder of a table no other query uses."""
    path = new_dir(spark, label)
    return path.rsplit("/", 1)[1].replace("-", "_"), path


@query("create_like_copy", "SELECT * FROM supplier")
def create_like_copy(spark, sf_dir):
    rows = roles.table(spark, sf_dir, "supplier")
    (template, first), (name, path) = _new_table(spark, "template"), _new_table(spark, "like")
    for _ in range(2):  # the second statement finds the table and leaves it
        tables.create_table(spark, template, rows.schema, path=first)
    tables.create_like(spark, name, template, path=path)
    tables.drop_table(spark, template)
    tables.append_rows(rows, name)
    return detached(spark, name, path)


@query("add_column_default", "SELECT *, 'Active' AS status FROM customer")
def add_column_default(spark, sf_dir):
    return relational.add_column(roles.table(spark, sf_dir, "customer"), "status", "string", "Active")


def _current(spark: SparkSession, name: str) -> DataFrame:
    """The rows a table's name stands for now, with the name given up."""
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]
    return detached(spark, name, location)


@query("truncate_then_load", "SELECT * FROM orders WHERE o_orderstatus = 'O'")
def truncate_then_load(spark, sf_dir):
    orders = roles.table(spark, sf_dir, "orders")
    name, path = _new_table(spark, "staging")
    tables.replace_table(orders, name, path)
    tables.truncate_table(spark, name)
    tables.append_rows(orders.filter("o_orderstatus = 'O'"), name)
    return _current(spark, name)


@query("replace_load", "SELECT * FROM orders WHERE o_totalprice > 100000")
def replace_load(spark, sf_dir):
    """The second load replaces the first, and reads it on the way."""
    name, path = _new_table(spark, "replaced")
    tables.replace_table(roles.table(spark, sf_dir, "orders"), name, path)
    tables.replace_table(spark.table(name).filter("o_totalprice > 100000"), name)
    return _current(spark, name)


@query("drop_recreate", "SELECT p_partkey, p_size FROM part")
def drop_recreate(spark, sf_dir):
    part = roles.table(spark, sf_dir, "part")
    (name, path), (_, narrow) = _new_table(spark, "dropped"), _new_table(spark, "recreated")
    tables.create_table(spark, name, part.schema, path=path)
    tables.drop_table(spark, name)
    tables.drop_table(spark, name)
    chosen = part.select("p_partkey", "p_size")
    tables.create_table(spark, name, chosen.schema, path=narrow)
    tables.append_rows(chosen, name)
    return detached(spark, name, narrow)


@query(
    "filtered_pair_lookup",
    f"""WITH {checks.TRIPS} SELECT pickup_datetime, dropoff_datetime, passenger_count, {money('total_amount')} FROM trips
        WHERE pulocationid = 18 AND dolocationid = 18""",
)
def filtered_pair_lookup(spark, sf_dir):
    pair = roles.trips(spark, sf_dir).filter((F.col("pulocationid") == 18) & (F.col("dolocationid") == 18))
    return as_double(pair.select("pickup_datetime", "dropoff_datetime", "passenger_count", "total_amount"), "total_amount")


_SIDED = f"""{checks.ZONES}, {checks.TRIPS}, counts AS (SELECT pulocationid, count(*) AS trips FROM trips
  WHERE pulocationid <> 3 GROUP BY 1)"""


def _trips_and_zones(spark, sf_dir, how: str) -> DataFrame:
    """Pickups per zone beside the known zones; either side lacks some of the other's."""
    trips = roles.trips(spark, sf_dir).filter("pulocationid <> 3").groupBy("pulocationid").agg(F.count("*").alias("trips"))
    known = zones(spark, sf_dir).filter("borough <> 'Unknown'").select("locationid", "zone")
    return trips.join(known, F.col("pulocationid") == F.col("locationid"), how).select("pulocationid", "trips", "zone")


@query("join_left", f"WITH {_SIDED} SELECT pulocationid, trips, zone FROM counts LEFT JOIN known_zones ON pulocationid = locationid")
def join_left(spark, sf_dir):
    return _trips_and_zones(spark, sf_dir, "left")


@query("join_right", f"WITH {_SIDED} SELECT pulocationid, trips, zone FROM counts RIGHT JOIN known_zones ON pulocationid = locationid")
def join_right(spark, sf_dir):
    return _trips_and_zones(spark, sf_dir, "right")


@query(
    "cte_group_by_ordinal",
    f"""WITH {checks.TRIPS}, kept AS (SELECT * FROM trips WHERE trip_distance > 1), monthly AS (
          SELECT service, CAST(month(pickup_datetime) AS INTEGER) AS month, count(*) AS trips FROM kept GROUP BY 1, 2)
        SELECT service, max(trips) AS busiest, sum(trips)::BIGINT AS trips FROM monthly GROUP BY 1""",
)
def cte_group_by_ordinal(spark, sf_dir):
    return spark.sql(
        """WITH kept AS (SELECT * FROM {trips} WHERE trip_distance > 1), monthly AS (
             SELECT service, month(pickup_datetime) AS month, count(*) AS trips FROM kept GROUP BY 1, 2)
           SELECT service, max(trips) AS busiest, sum(trips) AS trips FROM monthly GROUP BY 1""",
        trips=roles.trips(spark, sf_dir),
    )


_SHARED = [name for name in roles.GREEN_COLUMNS if name in roles.YELLOW_COLUMNS and "datetime" not in name]


@query(
    "shared_columns",
    f"WITH {checks.TRIPS} " + " UNION ALL ".join(f"SELECT '{name}' AS column_name, count({name}) AS non_null_rows FROM trips" for name in _SHARED),
)
def shared_columns(spark, sf_dir):
    """The columns both services' files have, with the values they hold in either."""
    united = relational.union_common(roles.green_trips(spark, sf_dir), roles.yellow_trips(spark, sf_dir), "green", "yellow")
    return files.column_summary(united.drop("service_type")).select("column_name", "non_null_rows")


@query("regexp_digits", "SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits FROM customer")
def regexp_digits(spark, sf_dir):
    return roles.table(spark, sf_dir, "customer").select("c_custkey", digits_only(F.col("c_name")).alias("digits"))


@query(
    "ingestion_stamp",
    f"""WITH {checks.TRIPS} SELECT strftime(pickup_datetime, 'green_tripdata_%Y-%m.csv') AS source_file, count(*) AS n_rows,
        true AS stamped FROM trips WHERE service = 'Green' GROUP BY 1""",
)
def ingestion_stamp(spark, sf_dir):
    landed = files.read_csv(spark, files.monthly_glob(monthly_csv(spark, sf_dir, "green"), "green"), SERVICES["green"].landing)
    now = F.current_timestamp()
    return files.with_provenance(landed).groupBy("source_file").agg(
        F.count("*").alias("n_rows"), F.every(F.col("ingestion_timestamp") <= now).alias("stamped"))


@query("batched_read", "SELECT count(*) AS n_rows, true AS bounded FROM lineitem")
def batched_read(spark, sf_dir):
    """A partitioned scan handed over in batches, counted in each."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([{"n": batch.num_rows}])

    batches = roles.table(spark, sf_dir, "lineitem").select("l_orderkey").mapInArrow(counted, "n long")
    return batches.agg(F.sum("n").alias("n_rows"), (F.max("n") <= BATCH_ROWS).alias("bounded"))


@query(
    "in_memory_frame",
    """SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def in_memory_frame(spark, sf_dir):
    """A lookup held by the driver, the one table of fixed size, joined to the customers."""
    held = roles.table(spark, sf_dir, "nation").select("n_nationkey", "n_name").toPandas()
    lookup = spark.createDataFrame(held, "n_nationkey int, n_name string")
    customers = roles.table(spark, sf_dir, "customer")
    return customers.join(lookup, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("customers"))


def _delivered(inbox: DataFrame) -> DataFrame:
    return messages.parse_events(inbox).select("test_data", F.col("event_time").alias("event_timestamp"))


@query("stream_resume", "SELECT user_id AS test_data, date_trunc('millisecond', ts)::TIMESTAMP AS event_timestamp FROM events")
def stream_resume(spark, sf_dir):
    """Two deliveries, the second read by a new query from the first one's checkpoint: every event once."""
    events, replay = roles.events(spark, sf_dir), Replay(spark, "resume")
    for part in (F.col("event_id") % 2 == 0, F.col("event_id") % 2 != 0):
        replay.step(as_event_messages(events.filter(part)), _delivered)
    return replay.rows(_delivered(as_event_messages(events)))


@query(
    "stream_fan_out",
    """SELECT sink, count(*) AS n_rows, min(user_id) AS lowest, max(user_id) AS highest
       FROM events, (VALUES ('all'), ('even')) AS s(sink) WHERE sink = 'all' OR user_id % 2 = 0 GROUP BY 1""",
)
def stream_fan_out(spark, sf_dir):
    """Each micro-batch goes to two sinks, one of which keeps some rows."""
    replay = Replay(spark, "fan-out")
    chosen = {"all": F.lit(True), "even": F.col("test_data") % 2 == 0}

    def fan(stream, out, checkpoint, available_now):
        writers = [
            lambda batch, n, name=name, rows=rows: batch.filter(rows).write.mode("overwrite").parquet(f"{out}/sink={name}/batch={n}")
            for name, rows in chosen.items()
        ]
        return sinks.fan_out(stream, writers, checkpoint, available_now)

    replay.step(as_event_messages(roles.events(spark, sf_dir)), _delivered, fan)
    return spark.read.parquet(replay.out).groupBy("sink").agg(
        F.count("*").alias("n_rows"), F.min("test_data").alias("lowest"), F.max("test_data").alias("highest"))
