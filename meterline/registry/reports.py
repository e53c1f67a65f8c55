"""Ad-hoc questions over trips: filters, joins, aggregates, top-k, set operations."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from meterline.operators import aggregates, relational, sessions
from meterline.operators.dimensions import known_zones, with_both_zones
from meterline.plans import report
from meterline.registry import checks
from meterline.registry.book import query
from meterline.registry.checks import money, moneys
from meterline.registry.models import as_double, rounded, zones
from meterline.sources import layout, roles
from meterline.workspace import materialize, new_dir

_TIE = ["pickup_datetime", "dropoff_datetime", "pulocationid", "dolocationid", "total_amount"]
_TIE_SQL = ", ".join(_TIE)


@query("count_trips", f"WITH {checks.TRIPS} SELECT count(*) AS trips FROM trips")
def count_trips(spark, sf_dir):
    return roles.trips(spark, sf_dir).agg(F.count("*").alias("trips"))


@query("distinct_pickups", f"WITH {checks.TRIPS} SELECT count(DISTINCT pulocationid) AS pickups FROM trips")
def distinct_pickups(spark, sf_dir):
    return roles.trips(spark, sf_dir).agg(F.count_distinct("pulocationid").alias("pickups"))


@query(
    "approx_distinct_pickups",
    f"WITH {checks.TRIPS} SELECT count(DISTINCT pulocationid) AS pickups, true AS within_error FROM trips",
)
def approx_distinct_pickups(spark, sf_dir):
    """The sketch's estimate, and whether it is within three of its standard errors of the exact count."""
    counted = roles.trips(spark, sf_dir).agg(
        F.count_distinct("pulocationid").alias("exact"), F.approx_count_distinct("pulocationid", 0.02).alias("pickups"))
    return counted.select("pickups", (F.abs(F.col("pickups") - F.col("exact")) <= 0.06 * F.col("exact")).alias("within_error"))


@query("project_columns", f"WITH {checks.TRIPS} SELECT pulocationid, dolocationid FROM trips")
def project_columns(spark, sf_dir):
    return roles.trips(spark, sf_dir).select("pulocationid", "dolocationid")


@query("filter_zero_fare", f"WITH {checks.TRIPS} SELECT count(*) AS no_fare FROM trips WHERE fare_amount = 0")
def filter_zero_fare(spark, sf_dir):
    return roles.trips(spark, sf_dir).filter(F.col("fare_amount") == 0).agg(F.count("*").alias("no_fare"))


@query(
    "date_range_scan",
    f"""WITH {checks.TRIPS} SELECT CAST(dropoff_datetime AS DATE) AS day, dolocationid FROM trips
        WHERE CAST(dropoff_datetime AS DATE) >= DATE '1998-10-01'
          AND CAST(dropoff_datetime AS DATE) < DATE '1998-11-01'""",
)
def date_range_scan(spark, sf_dir):
    october = relational.on_dates(
        roles.trips(spark, sf_dir, first=date(1998, 10, 1), end=date(1998, 11, 1)),
        "dropoff_datetime", date(1998, 10, 1), date(1998, 11, 1),
    )
    return october.select(F.to_date("dropoff_datetime").alias("day"), "dolocationid")


@query(
    "param_query",
    f"""WITH {checks.TRIPS} SELECT count(*) AS trips_count FROM trips
        WHERE CAST(dropoff_datetime AS DATE) >= DATE '1998-10-01'
          AND CAST(dropoff_datetime AS DATE) < DATE '1998-11-01' AND trip_distance > 1 AND trip_distance <= 3""",
)
def param_query(spark, sf_dir):
    return spark.sql(
        """SELECT count(*) AS trips_count FROM {trips}
           WHERE CAST(dropoff_datetime AS DATE) >= :start_date AND CAST(dropoff_datetime AS DATE) < :end_date
             AND trip_distance > :lower_bound AND trip_distance <= :upper_bound""",
        args={"start_date": date(1998, 10, 1), "end_date": date(1998, 11, 1), "lower_bound": 1, "upper_bound": 3},
        trips=roles.trips(spark, sf_dir, first=date(1998, 10, 1), end=date(1998, 11, 1)),
    )


@query(
    "rolling_days_filter",
    f"""WITH {checks.TRIPS} SELECT CAST(pickup_datetime AS DATE) AS day, count(*) AS n FROM trips
        WHERE pickup_datetime >= DATE '2000-06-30' - INTERVAL 30 DAY GROUP BY 1""",
)
def rolling_days_filter(spark, sf_dir):
    trips = roles.trips(spark, sf_dir, first=date(2000, 6, 30) - timedelta(days=30))
    recent = relational.last_days(trips, "pickup_datetime", date(2000, 6, 30), 30)
    return recent.groupBy(F.to_date("pickup_datetime").alias("day")).agg(F.count("*").alias("n"))


@query(
    "null_location_check",
    f"""WITH {checks.TRIPS} SELECT pickup_datetime, vendorid, dropoff_datetime, {money('total_amount')},
        {money('ehail_fee')} FROM trips WHERE vendorid IS NULL OR ehail_fee IS NULL""",
)
def null_location_check(spark, sf_dir):
    missing = roles.trips(spark, sf_dir).filter(F.col("vendorid").isNull() | F.col("ehail_fee").isNull())
    return as_double(
        missing.select("pickup_datetime", "vendorid", "dropoff_datetime", "total_amount", "ehail_fee"),
        "total_amount", "ehail_fee",
    )


@query(
    "orphan_not_in",
    f"""WITH {checks.ZONES}, {checks.TRIPS} SELECT pickup_datetime, pulocationid, dropoff_datetime, dolocationid,
        {money('total_amount')} FROM trips WHERE pulocationid NOT IN (SELECT locationid FROM known_zones)""",
)
def orphan_not_in(spark, sf_dir):
    trips = roles.trips(spark, sf_dir).select(
        "pickup_datetime", "pulocationid", "dropoff_datetime", "dolocationid", "total_amount"
    )
    known = known_zones(zones(spark, sf_dir))
    return as_double(relational.not_in(trips, "pulocationid", known, "locationid"), "total_amount")


@query(
    "longest_trip_subquery",
    f"""WITH {checks.TRIPS} SELECT pickup_datetime, trip_distance, trip_type FROM trips
        WHERE trip_distance = (SELECT max(trip_distance) FROM trips) AND trip_type = '1.0'""",
)
def longest_trip_subquery(spark, sf_dir):
    # The trips are read for the maximum and for the rows that hold it: stored, they are derived once.
    trips = materialize(roles.trips(spark, sf_dir).select("pickup_datetime", "trip_distance", "trip_type"), "distances")
    longest = relational.at_maximum(trips, "trip_distance")
    return longest.filter("trip_type = '1.0'").select("pickup_datetime", "trip_distance", "trip_type")


@query(
    "longest_trip",
    f"""WITH {checks.TRIPS} SELECT pickup_datetime, trip_distance, trip_type FROM trips
        ORDER BY trip_distance DESC, {_TIE_SQL} LIMIT 1""",
)
def longest_trip(spark, sf_dir):
    order = [F.col("trip_distance").desc(), *[F.col(name) for name in _TIE]]
    top = relational.first_rows(roles.trips(spark, sf_dir), order, 1)
    return top.select("pickup_datetime", "trip_distance", "trip_type")


@query(
    "preview_top_n",
    f"""WITH {checks.TRIPS} SELECT {_TIE_SQL.replace('total_amount', money('total_amount'))} FROM trips
        ORDER BY {_TIE_SQL.replace('total_amount', 'trips.total_amount')} LIMIT 10""",
)
def preview_top_n(spark, sf_dir):
    trips = roles.trips(spark, sf_dir).select(_TIE)
    return as_double(relational.first_rows(trips, [F.col(name) for name in _TIE], 10), "total_amount")


@query(
    "count_on_day",
    f"""WITH {checks.TRIPS} SELECT count(*) AS trips FROM trips
        WHERE CAST(pickup_datetime AS DATE) = DATE '1998-10-15'""",
)
def count_on_day(spark, sf_dir):
    first, end = date(1998, 10, 15), date(1998, 10, 16)
    day = relational.on_dates(roles.trips(spark, sf_dir, first=first, end=end), "pickup_datetime", first, end)
    return day.agg(F.count("*").alias("trips"))


@query(
    "distance_buckets",
    f"""WITH {checks.TRIPS} SELECT CASE WHEN trip_distance <= 1 THEN '<= 1' WHEN trip_distance <= 3 THEN '(1, 3]'
        WHEN trip_distance <= 7 THEN '(3, 7]' WHEN trip_distance <= 10 THEN '(7, 10]' ELSE '> 10' END AS bucket,
        count(*) AS trips FROM trips GROUP BY 1""",
)
def distance_buckets(spark, sf_dir):
    return aggregates.distance_buckets(roles.trips(spark, sf_dir))


@query(
    "daily_location_stats",
    f"""WITH {checks.TRIPS} SELECT CAST(dropoff_datetime AS DATE) AS day, dolocationid AS location,
        count(*) AS count, {money('max(total_amount)', 'max_total_amount')},
        max(passenger_count) AS max_passenger_count FROM trips GROUP BY 1, 2""",
)
def daily_location_stats(spark, sf_dir):
    stats = aggregates.daily_location_stats(roles.trips(spark, sf_dir), "dropoff_datetime", "dolocationid")
    return as_double(stats, "max_total_amount").orderBy("day", "location")


@query(
    "longest_trip_per_day",
    f"""WITH {checks.TRIPS} SELECT CAST(pickup_datetime AS DATE) AS pickup_date,
        round(max(date_sub('second', pickup_datetime, dropoff_datetime)) / 3600.0, 6) AS max_duration
        FROM trips GROUP BY 1 ORDER BY max(date_sub('second', pickup_datetime, dropoff_datetime)) DESC, 1 LIMIT 5""",
)
def longest_trip_per_day(spark, sf_dir):
    longest = aggregates.longest_per_day(roles.trips(spark, sf_dir), "pickup_datetime", "dropoff_datetime")
    top = relational.first_rows(longest, [F.col("max_duration").desc(), F.col("pickup_date")], 5)
    return rounded(top, "max_duration")


def _zoned(spark, sf_dir, first, end):
    """Trips picked up from the first day up to the end day, with both zones."""
    trips = relational.on_dates(roles.trips(spark, sf_dir, first=first, end=end), "pickup_datetime", first, end)
    return with_both_zones(trips, zones(spark, sf_dir), "pulocationid", "dolocationid")


_ZONED = f"""{checks.ZONES}, {checks.TRIPS}, zoned AS (
  SELECT trips.*, pz.zone AS pickup_zone, dz.zone AS dropoff_zone FROM trips
  JOIN dim_zones pz ON pulocationid = pz.locationid JOIN dim_zones dz ON dolocationid = dz.locationid)"""


@query(
    "top_pickup_zones",
    f"""WITH {_ZONED} SELECT pickup_zone, {money('sum(total_amount)', 'total_amount_sum')} FROM zoned
        WHERE CAST(pickup_datetime AS DATE) = DATE '1998-10-18' GROUP BY 1 HAVING sum(total_amount) > 13000""",
)
def top_pickup_zones(spark, sf_dir):
    day = _zoned(spark, sf_dir, date(1998, 10, 18), date(1998, 10, 19))
    sums = day.groupBy("pickup_zone").agg(F.sum("total_amount").alias("total_amount_sum"))
    return as_double(sums.filter(F.col("total_amount_sum") > 13000), "total_amount_sum").orderBy(
        F.col("total_amount_sum").desc()
    )


@query(
    "largest_tip",
    f"""WITH {_ZONED} SELECT dropoff_zone, {money('max(tip_amount)', 'largest_tip')} FROM zoned
        WHERE pickup_datetime >= DATE '1998-10-01' AND pickup_datetime < DATE '1998-11-01'
          AND pickup_zone = 'NATION_3' GROUP BY 1""",
)
def largest_tip(spark, sf_dir):
    october = _zoned(spark, sf_dir, date(1998, 10, 1), date(1998, 11, 1))
    tips = october.filter(F.col("pickup_zone") == "NATION_3").groupBy("dropoff_zone").agg(
        F.max("tip_amount").alias("largest_tip")
    )
    return as_double(tips, "largest_tip").orderBy(F.col("largest_tip").desc())


@query(
    "implicit_join",
    f"""WITH {checks.ZONES}, {checks.TRIPS} SELECT pickup_datetime, dropoff_datetime, {money('total_amount')},
        zpu.borough || '/' || zpu.zone AS pickup_loc, zdo.borough || '/' || zdo.zone AS dropoff_loc
        FROM trips, dim_zones zpu, dim_zones zdo
        WHERE pulocationid = zpu.locationid AND dolocationid = zdo.locationid""",
)
def implicit_join(spark, sf_dir):
    return spark.sql(
        """SELECT pickup_datetime, dropoff_datetime, CAST(total_amount AS DOUBLE) AS total_amount,
                  concat(zpu.borough, '/', zpu.zone) AS pickup_loc, concat(zdo.borough, '/', zdo.zone) AS dropoff_loc
           FROM {trips} AS t, {zones} AS zpu, {zones} AS zdo
           WHERE t.pulocationid = zpu.locationid AND t.dolocationid = zdo.locationid""",
        trips=roles.trips(spark, sf_dir), zones=zones(spark, sf_dir),
    )


@query(
    "least_frequent_zone",
    f"""WITH {checks.ZONES}, {checks.TRIPS}, least AS (SELECT pulocationid, count(*) AS trip_count FROM trips
        GROUP BY 1 ORDER BY 2, 1 LIMIT 1)
        SELECT zone, trip_count, borough FROM least JOIN dim_zones ON pulocationid = locationid""",
)
def least_frequent_zone(spark, sf_dir):
    counts = roles.trips(spark, sf_dir).groupBy("pulocationid").agg(F.count("*").alias("trip_count"))
    least = relational.first_rows(counts, [F.col("trip_count"), F.col("pulocationid")], 1)
    return least.join(zones(spark, sf_dir), F.col("pulocationid") == F.col("locationid")).select(
        "zone", "trip_count", "borough"
    )


@query(
    "least_frequent_zone_joined",
    f"""WITH {checks.ZONES}, {checks.TRIPS} SELECT pulocationid, borough, zone, service_zone, count(*) AS trip_count
        FROM trips JOIN dim_zones ON pulocationid = locationid GROUP BY 1, 2, 3, 4 ORDER BY 5, 1 LIMIT 1""",
)
def least_frequent_zone_joined(spark, sf_dir):
    joined = roles.trips(spark, sf_dir).join(zones(spark, sf_dir), F.col("pulocationid") == F.col("locationid"))
    counts = joined.groupBy("pulocationid", "borough", "zone", "service_zone").agg(F.count("*").alias("trip_count"))
    return relational.first_rows(counts, [F.col("trip_count"), F.col("pulocationid")], 1)


@query(
    "align_common_columns",
    f"""WITH {checks.TRIPS} SELECT lower(service) AS service_type, vendorid, store_and_fwd_flag, ratecodeid, pulocationid,
        dolocationid, passenger_count, trip_distance, payment_type, {moneys('fare_amount', 'extra', 'mta_tax',
        'tip_amount', 'tolls_amount', 'improvement_surcharge', 'total_amount', 'congestion_surcharge')} FROM trips""",
)
def align_common_columns(spark, sf_dir):
    # Pickup and drop-off names differ between the services, so they are not common.
    united = relational.union_common(
        roles.green_trips(spark, sf_dir), roles.yellow_trips(spark, sf_dir), "green", "yellow"
    )
    return as_double(
        united, "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
        "total_amount", "congestion_surcharge",
    )


@query(
    "count_by_service",
    f"WITH {checks.TRIPS} SELECT lower(service) AS service_type, count(*) AS count FROM trips GROUP BY 1",
)
def count_by_service(spark, sf_dir):
    united = report.both_services(roles.green_trips(spark, sf_dir), roles.yellow_trips(spark, sf_dir))
    return united.groupBy("service_type").count()


# Column names of the public trip tables and of the source files, yellow and green.
PUBLIC_YELLOW = {
    "vendor_id": "VendorID",
    "pickup_datetime": "tpep_pickup_datetime",
    "dropoff_datetime": "tpep_dropoff_datetime",
    "rate_code": "RatecodeID",
    "imp_surcharge": "improvement_surcharge",
    "pickup_location_id": "PULocationID",
    "dropoff_location_id": "DOLocationID",
}
PUBLIC_GREEN = {
    "vendor_id": "VendorID",
    "pickup_datetime": "lpep_pickup_datetime",
    "dropoff_datetime": "lpep_dropoff_datetime",
    "rate_code": "RatecodeID",
    "imp_surcharge": "improvement_surcharge",
    "pickup_location_id": "PULocationID",
    "dropoff_location_id": "DOLocationID",
}


@query(
    "rename_map",
    f"""WITH {checks.TRIPS} SELECT vendorid AS "VendorID", ratecodeid AS "RatecodeID", pulocationid AS "PULocationID",
        dolocationid AS "DOLocationID", {money('improvement_surcharge')},
        CASE WHEN service = 'Yellow' THEN pickup_datetime END AS tpep_pickup_datetime,
        CASE WHEN service = 'Yellow' THEN dropoff_datetime END AS tpep_dropoff_datetime,
        CASE WHEN service = 'Green' THEN pickup_datetime END AS lpep_pickup_datetime,
        CASE WHEN service = 'Green' THEN dropoff_datetime END AS lpep_dropoff_datetime FROM trips""",
)
def rename_map(spark, sf_dir):
    public = roles.trips(spark, sf_dir).select(
        "service", F.col("vendorid").alias("vendor_id"), "pickup_datetime", "dropoff_datetime",
        F.col("ratecodeid").alias("rate_code"), F.col("improvement_surcharge").cast("double").alias("imp_surcharge"),
        F.col("pulocationid").alias("pickup_location_id"), F.col("dolocationid").alias("dropoff_location_id"),
    )
    yellow = relational.rename(public.filter("service = 'Yellow'").drop("service"), PUBLIC_YELLOW)
    green = relational.rename(public.filter("service = 'Green'").drop("service"), PUBLIC_GREEN)
    return relational.append_all([yellow, green])


_SINCE = "1996-01-01 00:00:00"


def _hourly(service: str) -> str:
    return f"""SELECT date_trunc('hour', pickup_datetime)::TIMESTAMP AS hour, pulocationid AS zone,
        sum(total_amount) AS amount, count(*) AS number_records FROM trips
        WHERE service = '{service}' AND pickup_datetime >= TIMESTAMP '{_SINCE}' GROUP BY 1, 2"""


@query(
    "hourly_revenue",
    f"""WITH {checks.TRIPS}, hourly AS ({_hourly('Green')})
        SELECT hour, zone, {money('amount')}, number_records FROM hourly""",
)
def hourly_revenue(spark, sf_dir):
    hourly = aggregates.hourly_revenue(
        roles.green_trips(spark, sf_dir), "lpep_pickup_datetime", "pulocationid", _SINCE
    )
    return as_double(hourly, "amount")


@query(
    "hourly_revenue_rdd",
    f"""WITH {checks.TRIPS}, hourly AS ({_hourly('Green')})
        SELECT hour, zone, {money('amount', 'revenue')}, number_records AS count FROM hourly""",
)
def hourly_revenue_rdd(spark, sf_dir):
    hourly = aggregates.hourly_revenue_by_key(
        roles.green_trips(spark, sf_dir), "lpep_pickup_datetime", "pulocationid", _SINCE
    )
    return as_double(hourly, "revenue")


def _zone_hours(spark, sf_dir):
    # Both services are added up in one pass; the short result is stored and joined with itself.
    trips = roles.trips(spark, sf_dir, first=date.fromisoformat(_SINCE[:10]))
    hourly = materialize(aggregates.hourly_revenue(trips, "pickup_datetime", "pulocationid", _SINCE, ["service"]), "hourly")
    sides = [
        hourly.filter(F.col("service") == service).drop("service").withColumnsRenamed(
            {"amount": f"{name}_amount", "number_records": f"{name}_number_records"})
        for name, service in (("green", "Green"), ("yellow", "Yellow"))
    ]
    return as_double(sides[0].join(sides[1], ["hour", "zone"], "outer"), "green_amount", "yellow_amount")


_OUTER = f"""{checks.TRIPS}, green AS ({_hourly('Green')}), yellow AS ({_hourly('Yellow')}), both_services AS (
  SELECT coalesce(g.hour, y.hour) AS hour, coalesce(g.zone, y.zone) AS zone,
    {money('g.amount', 'green_amount')}, g.number_records AS green_number_records,
    {money('y.amount', 'yellow_amount')}, y.number_records AS yellow_number_records
  FROM green g FULL JOIN yellow y ON g.hour = y.hour AND g.zone = y.zone)"""


@query("zone_hour_outer", f"WITH {_OUTER} SELECT * FROM both_services")
def zone_hour_outer(spark, sf_dir):
    return _zone_hours(spark, sf_dir)


@query(
    "zone_hour_join",
    f"""WITH {_OUTER}, {checks.ZONES} SELECT b.* EXCLUDE (zone), d.borough, d.zone AS zone_name, d.service_zone
        FROM both_services b JOIN dim_zones d ON b.zone = d.locationid""",
)
def zone_hour_join(spark, sf_dir):
    named = zones(spark, sf_dir).withColumnRenamed("zone", "zone_name")
    joined = _zone_hours(spark, sf_dir).join(named, F.col("zone") == F.col("locationid"))
    return joined.drop("locationid", "zone")


_LOCATION_SQL = f"""WITH {checks.TRIPS} SELECT pulocationid AS revenue_zone,
    date_trunc('month', pickup_datetime)::TIMESTAMP AS revenue_month, lower(service) AS service_type,
    {', '.join(money(f'sum({c})', f'revenue_monthly_{n}') for n, c in report.SUMMED.items())},
    round(avg(CAST(passenger_count AS DOUBLE)), 6) AS avg_monthly_passenger_count,
    round(avg(trip_distance), 6) AS avg_monthly_trip_distance FROM trips GROUP BY 1, 2, 3"""


def _location_revenue(spark, sf_dir):
    trips = report.both_services(roles.green_trips(spark, sf_dir), roles.yellow_trips(spark, sf_dir))
    revenue = as_double(
        report.monthly_location_revenue(trips), *[f"revenue_monthly_{name}" for name in report.SUMMED]
    )
    return rounded(revenue, "avg_monthly_passenger_count", "avg_monthly_trip_distance")


@query("monthly_location_revenue", _LOCATION_SQL)
def monthly_location_revenue(spark, sf_dir):
    return _location_revenue(spark, sf_dir)


@query("report_single_file", _LOCATION_SQL)
def report_single_file(spark, sf_dir):
    path = new_dir(spark, "report")
    layout.write_single_file(_location_revenue(spark, sf_dir), path)
    return spark.read.parquet(path)


def _islands(partition: str, gap: str) -> str:
    over = f"({partition} ORDER BY ts)"
    return f"""marked AS (SELECT *, CASE WHEN ts > lag(ts) OVER {over} + INTERVAL {gap}
          OR lag(ts) OVER {over} IS NULL THEN 1 ELSE 0 END AS opens FROM events),
        numbered AS (SELECT *, sum(opens) OVER ({partition} ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session
          FROM marked)"""


@query(
    "global_session_pairs",
    f"""WITH {_islands('', '5 MINUTE')}, spans AS (SELECT session, min(ts) AS session_start,
          max(ts) + INTERVAL 5 MINUTE AS session_end FROM numbered GROUP BY 1)
        SELECT session_start, session_end, user_id, event_type, count(*) AS trip_count
        FROM numbered JOIN spans USING (session) GROUP BY 1, 2, 3, 4""",
)
def global_session_pairs(spark, sf_dir):
    return sessions.global_session_pairs(roles.events(spark, sf_dir), "ts", 5 * 60, ["user_id", "event_type"])


@query(
    "longest_streak",
    f"""WITH {_islands('PARTITION BY user_id, event_type', '6 HOUR')}, streaks AS (
          SELECT user_id, event_type, session, count(*) AS n FROM numbered GROUP BY 1, 2, 3)
        SELECT user_id, event_type, max(n) AS longest_streak FROM streaks GROUP BY 1, 2""",
)
def longest_streak(spark, sf_dir):
    pair = ["user_id", "event_type"]
    streaks = sessions.sessions(roles.events(spark, sf_dir), "ts", 6 * 3600, pair, "streak_length")
    return sessions.longest_streaks(streaks, pair)
