"""Building blocks of the check SQL: the trip roles and models, as CTE text."""

from __future__ import annotations

ZONES = """zone_seed AS (
  SELECT n_nationkey AS locationid,
         CASE WHEN r_name = 'MIDDLE EAST' THEN 'Unknown' ELSE r_name END AS borough,
         n_name AS zone,
         CASE WHEN r_name = 'AFRICA' THEN 'EWR' WHEN r_name IN ('AMERICA', 'ASIA') THEN 'Boro Zone'
              ELSE 'Yellow Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
), dim_zones AS (
  SELECT locationid, borough, zone, replace(service_zone, 'Boro', 'Green') AS service_zone FROM zone_seed
), known_zones AS (SELECT * FROM dim_zones WHERE borough <> 'Unknown')"""

TRIPS = """timed AS (
  SELECT l.*, c_nationkey, s_nationkey, o_orderpriority,
         o_orderdate + to_hours(CAST(l_orderkey % 24 AS INTEGER))
                     + to_minutes(CAST(l_suppkey % 60 AS INTEGER)) AS pickup_datetime,
         CASE WHEN l_partkey % 50 = 0 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS fare,
         CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS tip
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
), trips AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 'Green' ELSE 'Yellow' END AS service,
         CAST(nullif(l_linenumber % 4, 0) AS INTEGER) AS vendorid,
         pickup_datetime,
         pickup_datetime + to_seconds(CAST(l_quantity * 60 AS INTEGER) + CAST(l_partkey % 60 AS INTEGER))
           AS dropoff_datetime,
         CASE WHEN l_partkey % 2 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
         CAST(l_partkey % 6 + 1 AS VARCHAR) || '.0' AS ratecodeid,
         c_nationkey AS pulocationid, s_nationkey AS dolocationid,
         l_linenumber AS passenger_count, l_quantity / 4 AS trip_distance,
         CAST(fare AS DECIMAL(12,2)) AS fare_amount,
         CAST(l_tax AS DECIMAL(4,2)) AS extra, CAST(0.5 AS DECIMAL(4,2)) AS mta_tax,
         CAST(tip AS DECIMAL(17,4)) AS tip_amount, CAST(0 AS DECIMAL(12,2)) AS tolls_amount,
         CASE WHEN l_suppkey % 3 = 0 THEN CAST(1.25 AS DECIMAL(4,2)) END AS ehail_fee,
         CAST(0.3 AS DECIMAL(4,2)) AS improvement_surcharge,
         CAST(fare + CAST(l_tax AS DECIMAL(4,2)) + 0.5 + tip + 0 + 0.3 AS DECIMAL(18,4)) AS total_amount,
         substr(o_orderpriority, 1, 1) || '.0' AS payment_type,
         CAST(l_suppkey % 2 + 1 AS VARCHAR) || '.0' AS trip_type,
         CAST(2.5 AS DECIMAL(4,2)) AS congestion_surcharge,
         l_returnflag, l_suppkey, l_linenumber
  FROM timed
)"""

LABEL = """CASE CAST(round(TRY_CAST(payment_type AS DOUBLE)) AS INTEGER)
           WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute'
           WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' ELSE 'EMPTY' END"""


def surrogate_key(*columns: str) -> str:
    """Check SQL of the surrogate key."""
    parts = [f"coalesce(CAST({c} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for c in columns]
    return "md5(" + " || '-' || ".join(parts) + ")"


def _staging(name: str, service: str, order: str, trip_type: str, ehail: str, payment: str) -> str:
    return f"""{name} AS (
  SELECT {surrogate_key('vendorid', 'pickup_datetime')} AS tripid, vendorid,
         CAST(round(TRY_CAST(ratecodeid AS DOUBLE)) AS INTEGER) AS ratecodeid,
         pulocationid AS pickup_locationid, dolocationid AS dropoff_locationid,
         pickup_datetime, dropoff_datetime, store_and_fwd_flag, passenger_count,
         CAST(trip_distance AS DECIMAL(38,9)) AS trip_distance, {trip_type} AS trip_type,
         CAST(fare_amount AS DECIMAL(38,9)) AS fare_amount, CAST(extra AS DECIMAL(38,9)) AS extra,
         CAST(mta_tax AS DECIMAL(38,9)) AS mta_tax, CAST(tip_amount AS DECIMAL(38,9)) AS tip_amount,
         CAST(tolls_amount AS DECIMAL(38,9)) AS tolls_amount, CAST({ehail} AS DECIMAL(38,9)) AS ehail_fee,
         CAST(improvement_surcharge AS DECIMAL(38,9)) AS improvement_surcharge,
         CAST(total_amount AS DECIMAL(38,9)) AS total_amount,
         {payment} AS payment_type, {LABEL} AS payment_type_description
  FROM (SELECT *, row_number() OVER (PARTITION BY vendorid, pickup_datetime ORDER BY {order}) AS rn
        FROM trips WHERE service = '{service}' AND vendorid IS NOT NULL)
  WHERE rn = 1
)"""


def _order(columns: list[str]) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in columns)


STG_GREEN = _staging(
    "stg_green", "Green",
    _order(["dropoff_datetime", "store_and_fwd_flag", "ratecodeid", "pulocationid", "dolocationid",
            "passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
            "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount", "payment_type",
            "trip_type"]),
    "CAST(round(TRY_CAST(trip_type AS DOUBLE)) AS INTEGER)", "ehail_fee",
    "coalesce(CAST(round(TRY_CAST(payment_type AS DOUBLE)) AS INTEGER), 0)",
)
STG_YELLOW = _staging(
    "stg_yellow", "Yellow",
    _order(["dropoff_datetime", "passenger_count", "trip_distance", "ratecodeid", "store_and_fwd_flag",
            "pulocationid", "dolocationid", "payment_type", "fare_amount", "extra", "mta_tax",
            "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount"]),
    "1", "0",
    # A plain integer cast of text refuses '1.0'.
    "coalesce(CASE WHEN regexp_full_match(payment_type, '[0-9]+') THEN TRY_CAST(payment_type AS INTEGER) END, 0)",
)

FACTS = f"""{ZONES}, {TRIPS}, {STG_GREEN}, {STG_YELLOW}, unioned AS (
  SELECT *, 'Green' AS service_type FROM stg_green UNION ALL SELECT *, 'Yellow' AS service_type FROM stg_yellow
), fact_trips AS (
  SELECT u.*, pz.borough AS pickup_borough, pz.zone AS pickup_zone,
         dz.borough AS dropoff_borough, dz.zone AS dropoff_zone
  FROM unioned u JOIN known_zones pz ON u.pickup_locationid = pz.locationid
       JOIN known_zones dz ON u.dropoff_locationid = dz.locationid
)"""

FHV = f"""{ZONES}, {TRIPS}, fhv AS (
  SELECT CASE WHEN l_suppkey % 10 <> 0 THEN 'B' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') END
           AS dispatching_base_num,
         pickup_datetime, dropoff_datetime, pulocationid, dolocationid,
         CASE WHEN l_linenumber % 3 = 0 THEN '1' END AS sr_flag
  FROM trips WHERE l_returnflag = 'N'
), stg_fhv AS (
  SELECT dispatching_base_num, pulocationid AS pickup_locationid, dolocationid AS dropoff_locationid,
         pickup_datetime, dropoff_datetime, sr_flag
  FROM fhv WHERE year(pickup_datetime) = 1999 AND dispatching_base_num IS NOT NULL
), fact_fhv AS (
  SELECT f.*, 'Fhv' AS service_type, pz.borough AS pickup_borough, pz.zone AS pickup_zone,
         dz.borough AS dropoff_borough, dz.zone AS dropoff_zone,
         CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month
  FROM stg_fhv f JOIN known_zones pz ON f.pickup_locationid = pz.locationid
       JOIN known_zones dz ON f.dropoff_locationid = dz.locationid
), travel AS (
  SELECT dispatching_base_num, year, month, pickup_zone, dropoff_zone,
         date_sub('second', pickup_datetime, dropoff_datetime) AS trip_duration,
         dropoff_locationid, pickup_locationid, service_type
  FROM fact_fhv
)"""


def money(expression: str, name: str | None = None) -> str:
    """A money value as double, rounded correctly (test data has at most four decimals)."""
    return f"CAST(CAST({expression} AS DECIMAL(18,4)) AS DOUBLE) AS {name or expression}"


def moneys(*names: str) -> str:
    return ", ".join(money(name) for name in names)
