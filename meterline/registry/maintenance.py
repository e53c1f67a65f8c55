"""Table maintenance and data quality."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from meterline.functions.keys import row_hash, surrogate_key
from meterline.operators import quality, relational, tables
from meterline.plans import staging
from meterline.registry import checks
from meterline.registry.book import query
from meterline.registry.checks import money
from meterline.registry.models import as_double
from meterline.sources import roles
from meterline.workspace import materialize

_ID = ["vendorid", "pickup_datetime", "dropoff_datetime", "pulocationid", "dolocationid"]
_ID_SQL = """md5(coalesce(CAST(vendorid AS VARCHAR), '') || CAST(pickup_datetime AS VARCHAR)
    || CAST(dropoff_datetime AS VARCHAR) || CAST(pulocationid AS VARCHAR) || CAST(dolocationid AS VARCHAR))"""


def _identified(spark, sf_dir):
    trips = roles.trips(spark, sf_dir)
    return trips.select(
        row_hash(*[F.col(name) for name in _ID]).alias("unique_row_id"),
        "service", "vendorid", "pickup_datetime", "passenger_count", "total_amount",
    )


@query(
    "merge_insert_only",
    f"""WITH {checks.TRIPS}, ided AS (SELECT {_ID_SQL} AS unique_row_id, service, vendorid, pickup_datetime,
          passenger_count, total_amount FROM trips),
        target AS (SELECT * FROM ided WHERE pickup_datetime < TIMESTAMP '1999-01-01'),
        source AS (SELECT * FROM ided WHERE pickup_datetime >= TIMESTAMP '1998-06-01')
        SELECT unique_row_id, service, vendorid, pickup_datetime, passenger_count, {money('total_amount')} FROM
          (SELECT * FROM target UNION ALL
           SELECT * FROM source WHERE unique_row_id NOT IN (SELECT unique_row_id FROM target))""",
)
def merge_insert_only(spark, sf_dir):
    # The two loads overlap by seven months. Both are read from one stored derivation.
    trips = materialize(_identified(spark, sf_dir), "identified")
    target = trips.filter(F.col("pickup_datetime") < F.lit("1999-01-01").cast("timestamp"))
    source = trips.filter(F.col("pickup_datetime") >= F.lit("1998-06-01").cast("timestamp"))
    return as_double(tables.merge_insert_only(target, source, "unique_row_id"), "total_amount")


@query(
    "merge_upsert",
    f"""WITH {checks.TRIPS}, narrow AS (SELECT vendorid, pickup_datetime, passenger_count, total_amount FROM trips),
        target AS (SELECT *, 'old' AS origin FROM narrow WHERE pickup_datetime < TIMESTAMP '1999-01-01'),
        source AS (SELECT *, 'new' AS origin FROM (SELECT *, row_number() OVER (PARTITION BY vendorid,
          pickup_datetime ORDER BY total_amount DESC, passenger_count) AS rn FROM narrow
          WHERE pickup_datetime >= TIMESTAMP '1998-06-01') WHERE rn = 1)
        SELECT vendorid, pickup_datetime, passenger_count, origin, {money('total_amount')} FROM (
          SELECT vendorid, pickup_datetime, passenger_count, total_amount, origin FROM source UNION ALL
          SELECT vendorid, pickup_datetime, passenger_count, total_amount, origin FROM target t
          WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.vendorid IS NOT DISTINCT FROM t.vendorid
                            AND s.pickup_datetime = t.pickup_datetime))""",
)
def merge_upsert(spark, sf_dir):
    narrow = roles.trips(spark, sf_dir).select("vendorid", "pickup_datetime", "passenger_count", "total_amount")
    trips = materialize(narrow, "narrow-trips")
    target = trips.filter(F.col("pickup_datetime") < F.lit("1999-01-01").cast("timestamp"))
    source = trips.filter(F.col("pickup_datetime") >= F.lit("1998-06-01").cast("timestamp"))
    merged = tables.merge_upsert(
        target.withColumn("origin", F.lit("old")), source.withColumn("origin", F.lit("new")),
        ["pickup_datetime", "vendorid"], [F.col("total_amount").desc(), F.col("passenger_count")],
    )
    return as_double(merged, "total_amount")


@query(
    "delete_where",
    f"""WITH {checks.TRIPS} SELECT service, vendorid, count(*) AS n FROM trips
        WHERE NOT coalesce(vendorid = 2, false) GROUP BY 1, 2""",
)
def delete_where(spark, sf_dir):
    left = relational.delete_where(roles.trips(spark, sf_dir), F.col("vendorid") == 2)
    return left.groupBy("service", "vendorid").agg(F.count("*").alias("n"))


@query(
    "dq_unique",
    f"""WITH {checks.TRIPS} SELECT {checks.surrogate_key('vendorid', 'pickup_datetime')} AS tripid,
        count(*) AS n_records FROM trips GROUP BY 1 HAVING count(*) > 1""",
)
def dq_unique(spark, sf_dir):
    keyed = roles.trips(spark, sf_dir).select(
        surrogate_key(F.col("vendorid"), F.col("pickup_datetime")).alias("tripid")
    )
    return quality.duplicate_keys(keyed, "tripid")


@query(
    "dq_not_null",
    f"""WITH {checks.TRIPS} SELECT 'vendorid' AS column_name, count_if(vendorid IS NULL) AS null_rows FROM trips
        UNION ALL SELECT 'ehail_fee', count_if(ehail_fee IS NULL) FROM trips
        UNION ALL SELECT 'total_amount', count_if(total_amount IS NULL) FROM trips""",
)
def dq_not_null(spark, sf_dir):
    return quality.null_counts(roles.trips(spark, sf_dir), ["vendorid", "ehail_fee", "total_amount"])


_STAGED = f"""{checks.ZONES}, {checks.TRIPS}, {checks.STG_GREEN}, {checks.STG_YELLOW},
    staged AS (SELECT *, 'Green' AS service_type FROM stg_green UNION ALL SELECT *, 'Yellow' FROM stg_yellow)"""
_PAYMENTS = [1, 2, 3, 4, 5, 6]


def _staged(spark, sf_dir):
    """Staged rows of both services: several checks read them, so they are stored once."""
    columns = ["service_type", "tripid", "pickup_locationid", "dropoff_locationid", "payment_type", "total_amount"]
    return materialize(staging.stage_services(roles.trips(spark, sf_dir)).select(columns), "staged")


@query(
    "dq_relationships",
    f"WITH {_STAGED} " + " UNION ALL ".join(
        f"""SELECT service_type, '{end}' AS trip_end, {end}_locationid AS locationid, count(*) AS n_records FROM staged
        WHERE {end}_locationid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM zone_seed WHERE locationid = {end}_locationid)
        GROUP BY 1, 2, 3""" for end in ("pickup", "dropoff")
    ) + """ UNION ALL SELECT service_type, 'checked', NULL, 2 * count(*) FROM staged GROUP BY 1""",
)
def dq_relationships(spark, sf_dir):
    """Zone ids of either trip end that the lookup lacks, and how many ids were checked, per service."""
    staged, lookup = _staged(spark, sf_dir), roles.zone_seed(spark, sf_dir)
    ends = [
        quality.orphans(staged.select("service_type", F.col(f"{end}_locationid").alias("locationid")), "locationid", lookup, "locationid")
        .groupBy("service_type", F.lit(end).alias("trip_end"), "locationid").agg(F.count("*").alias("n_records"))
        for end in ("pickup", "dropoff")
    ]
    checked = staged.groupBy("service_type").agg((2 * F.count("*")).alias("n_records")).select(
        "service_type", F.lit("checked").alias("trip_end"), F.lit(None).cast("int").alias("locationid"), "n_records")
    return ends[0].unionByName(ends[1]).unionByName(checked)


@query(
    "dq_accepted_values",
    f"""WITH {_STAGED} SELECT service_type, payment_type AS value_field, count(*) AS n_records
        FROM staged WHERE payment_type NOT IN (1, 2, 3, 4, 5, 6) GROUP BY 1, 2""",
)
def dq_accepted_values(spark, sf_dir):
    return quality.unaccepted_values(_staged(spark, sf_dir), "payment_type", _PAYMENTS, ["service_type"])


# The declared severities per service; the lookup is the parent of both ends.
_SEVERITIES = {
    "Green": {"unique": "warn", "not_null": "warn", "pickup": "warn", "dropoff": "error", "payment_type": "warn"},
    "Yellow": {"unique": "warn", "not_null": "warn", "pickup": "warn", "dropoff": "warn", "payment_type": "warn"},
}


def _failures(service: str) -> dict[str, str]:
    of = f"staged WHERE service_type = '{service}'"
    return {
        "unique": f"SELECT count(*) FROM (SELECT tripid FROM {of} GROUP BY 1 HAVING count(*) > 1)",
        "not_null": f"SELECT count(*) FROM {of} AND tripid IS NULL",
        "pickup": f"SELECT count(*) FROM {of} AND pickup_locationid NOT IN (SELECT locationid FROM zone_seed)",
        "dropoff": f"SELECT count(*) FROM {of} AND dropoff_locationid NOT IN (SELECT locationid FROM zone_seed)",
        "payment_type": f"SELECT count(*) FROM {of} AND payment_type NOT IN (1, 2, 3, 4, 5, 6)",
    }


@query(
    "dq_report",
    f"WITH {_STAGED}, lines AS ("
    + " UNION ALL ".join(
        f"SELECT '{service.lower()}_{name}' AS check_name, ({sql}) AS failures, '{_SEVERITIES[service][name]}' AS severity"
        for service in _SEVERITIES for name, sql in _failures(service).items()
    )
    + ") SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status FROM lines",
)
def dq_report(spark, sf_dir):
    staged, lookup = _staged(spark, sf_dir), roles.zone_seed(spark, sf_dir)
    flagged = quality.flag_orphans(staged, "pickup_locationid", lookup, "locationid", "_pickup_orphan")
    flagged = quality.flag_orphans(flagged, "dropoff_locationid", lookup, "locationid", "_dropoff_orphan")
    failing = {
        "not_null": F.col("tripid").isNull(), "pickup": F.col("_pickup_orphan"), "dropoff": F.col("_dropoff_orphan"),
        "payment_type": ~F.col("payment_type").isin(*_PAYMENTS),
    }
    row_checks, key_checks = [], []
    for service, severities in _SEVERITIES.items():
        mine = F.col("service_type") == service
        row_checks += [
            quality.RowCheck(f"{service.lower()}_{name}", mine & condition, severities[name]) for name, condition in failing.items()
        ]
        key_checks.append(quality.KeyCheck(f"{service.lower()}_unique", "tripid", severities["unique"], mine))
    return quality.report(flagged, row_checks, key_checks)


@query(
    "dq_freshness",
    """SELECT max(ts) AS max_loaded_at,
       round(date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-03-01 00:00:00') / 3600.0, 6)
         AS age_hours,
       CASE WHEN date_diff('second', max(ts), TIMESTAMP '2024-03-01 00:00:00') / 3600.0 > 720 THEN 'error'
            WHEN date_diff('second', max(ts), TIMESTAMP '2024-03-01 00:00:00') / 3600.0 > 24 THEN 'warn'
            ELSE 'pass' END AS status FROM events""",
)
def dq_freshness(spark, sf_dir):
    line = quality.freshness(
        roles.events(spark, sf_dir), "ts", datetime(2024, 3, 1), warn_hours=24, error_hours=720
    )
    return line.withColumn("age_hours", F.round("age_hours", 6))
