"""DuckDB twins of the registered queries (``__spark_entry__.oracle_sql()``).

Every SQL text starts from the driver's raw tables: the fixture views are
inlined as CTEs, then the stage CTEs below rebuild Silver, the facts and the
demand series independently of the Spark code.

Engine differences handled here (not in the operators):
* ``R(x, n)`` rounds half-up on the shortest decimal text of the double,
  which is what Spark's ``round`` does; DuckDB's own ``round`` differs on ties.
* DuckDB ``dayofweek`` is 0-6 from Sunday (Spark 1-7); ``year``/``hour`` are
  BIGINT there and ``sum(int)`` is HUGEINT, so they are cast.
"""

from __future__ import annotations

from tripflow.sources.fixtures import duckdb_fixture_sql

ORACLE: dict[str, str] = {}


def R(x: str, n: int = 4) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), {n}) AS DOUBLE)"


def rounded(sql: str, doubles: list[str] | tuple[str, ...]) -> str:
    """Round the named double columns of ``sql``'s result to 9 places (drops
    summation-order noise), then to 4, as the Spark side does."""
    if not doubles:
        return sql
    repl = ", ".join(f"{R(R(c, 9))} AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM ({sql}) q"


def with_ctes(ctes: list[str], body: str) -> str:
    return body if not ctes else "WITH " + ",\n".join(ctes) + "\n" + body


# ------------------------------------------------------------- fixtures
T = f"T AS ({duckdb_fixture_sql('T')})"
H = f"H AS ({duckdb_fixture_sql('H')})"
L = f"L AS ({duckdb_fixture_sql('L')})"

# H typed to the declared schema: absent columns become typed NULLs.
HT = """HT AS (
 SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count,
  trip_distance, CAST(NULL AS BIGINT) AS RatecodeID, CAST(NULL AS VARCHAR) AS store_and_fwd_flag,
  PULocationID, CAST(NULL AS BIGINT) AS DOLocationID, CAST(NULL AS BIGINT) AS payment_type,
  fare_amount, CAST(NULL AS DOUBLE) AS extra, CAST(NULL AS DOUBLE) AS mta_tax,
  CAST(NULL AS DOUBLE) AS tip_amount, CAST(NULL AS DOUBLE) AS tolls_amount,
  CAST(NULL AS DOUBLE) AS improvement_surcharge, total_amount,
  CAST(NULL AS DOUBLE) AS congestion_surcharge, CAST(NULL AS DOUBLE) AS airport_fee,
  CAST(NULL AS DOUBLE) AS cbd_congestion_fee
 FROM H)"""


def silver_ctes(name: str, src: str) -> list[str]:
    """Silver rules over a Bronze-shaped relation ``src``."""
    return [
        f"""{name}_d AS (
 SELECT VendorID AS vendor_id, tpep_pickup_datetime AS pickup_datetime,
  tpep_dropoff_datetime AS dropoff_datetime, coalesce(passenger_count, 1) AS passenger_count,
  trip_distance, coalesce(RatecodeID, 99) AS ratecode_id,
  coalesce(store_and_fwd_flag, 'N') AS store_and_fwd_flag, PULocationID AS pu_location_id,
  DOLocationID AS do_location_id, payment_type, fare_amount, extra, mta_tax, tip_amount,
  tolls_amount, improvement_surcharge, total_amount,
  coalesce(congestion_surcharge, 0.0) AS congestion_surcharge,
  coalesce(airport_fee, 0.0) AS airport_fee,
  coalesce(cbd_congestion_fee, 0.0) AS cbd_congestion_fee
 FROM {src})""",
        f"""{name}_f AS (
 SELECT *,
  CASE WHEN airport_fee > 0 THEN 1 ELSE 0 END AS is_airport_trip,
  CASE WHEN cbd_congestion_fee > 0 THEN 1 ELSE 0 END AS is_cbd_trip,
  CASE WHEN extra + mta_tax + tolls_amount + congestion_surcharge > 0 THEN 1 ELSE 0 END AS has_extra_charges,
  CAST(dropoff_datetime AS DATE) AS trip_date,
  CAST(year(dropoff_datetime) AS INTEGER) AS trip_year,
  CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
  CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS pickup_day,
  CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
  CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
  {R('total_amount - fare_amount', 2)} AS extra_charges,
  CAST(floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime)) AS BIGINT) AS trip_duration_seconds,
  {R('fare_amount / trip_distance', 2)} AS fare_per_mile
 FROM {name}_d
 WHERE fare_amount BETWEEN 3 AND 200 AND total_amount > 0
  AND trip_distance BETWEEN 0.5 AND 100 AND passenger_count BETWEEN 1 AND 6
  AND dropoff_datetime > pickup_datetime)""",
        f"""{name} AS (
 SELECT *, {R('trip_duration_seconds / 60', 2)} AS trip_duration_minutes
 FROM {name}_f
 WHERE trip_duration_seconds > 0 AND fare_per_mile > 0 AND fare_per_mile < 100)""",
    ]


# Silver over T (every year) and over H.
ST_CTES = [T, *silver_ctes("ST", "T")]
SH_CTES = [H, HT, *silver_ctes("SH", "HT")]

SILVER_COLS = (
    "vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance, "
    "ratecode_id, store_and_fwd_flag, pu_location_id, do_location_id, payment_type, "
    "fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, "
    "total_amount, congestion_surcharge, airport_fee, cbd_congestion_fee, "
    "is_airport_trip, is_cbd_trip, has_extra_charges, trip_date, trip_year, "
    "pickup_hour, pickup_day, pickup_month, pickup_year, extra_charges, "
    "trip_duration_seconds, trip_duration_minutes, fare_per_mile"
)
SILVER_DOUBLES = (
    "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee",
    "cbd_congestion_fee", "extra_charges", "trip_duration_minutes", "fare_per_mile",
)

ORACLE["silver_trips"] = rounded(
    with_ctes(ST_CTES, f"SELECT {SILVER_COLS} FROM ST"), SILVER_DOUBLES
)

# ------------------------------------------------------------- facts
REV = "count(*) AS total_trips, sum(total_amount) AS total_revenue, avg(total_amount) AS avg_trip_value"
FEES = (
    "sum(airport_fee) AS total_airport_fee, sum(congestion_surcharge) AS total_congestion_fee, "
    "sum(cbd_congestion_fee) AS total_cbd_fee"
)
FACT_SQL = {
    "fact_trip_yearly_summary": (
        f"SELECT trip_year, {REV}, sum(trip_distance) AS total_distance, "
        f"avg(trip_distance) AS avg_distance, avg(fare_per_mile) AS avg_fare_per_mile, "
        f"avg(passenger_count) AS avg_passengers, {FEES} FROM ST GROUP BY trip_year",
        ("total_revenue", "avg_trip_value", "total_distance", "avg_distance",
         "avg_fare_per_mile", "avg_passengers", "total_airport_fee",
         "total_congestion_fee", "total_cbd_fee"),
    ),
    "fact_payment_summary": (
        f"SELECT trip_year, payment_type, {REV}, avg(fare_per_mile) AS avg_fare_per_mile "
        f"FROM ST GROUP BY trip_year, payment_type",
        ("total_revenue", "avg_trip_value", "avg_fare_per_mile"),
    ),
    "fact_location_summary": (
        f"SELECT trip_year, pu_location_id, {REV}, avg(trip_distance) AS avg_distance, "
        f"avg(fare_per_mile) AS avg_fare_per_mile FROM ST GROUP BY trip_year, pu_location_id",
        ("total_revenue", "avg_trip_value", "avg_distance", "avg_fare_per_mile"),
    ),
    "fact_distance_summary": (
        f"SELECT trip_year, distance_bucket, {REV}, avg(fare_per_mile) AS avg_fare_per_mile, "
        f"avg(trip_distance) AS avg_distance FROM (SELECT *, CASE WHEN trip_distance < 2 THEN 'short' "
        f"WHEN trip_distance < 10 THEN 'medium' ELSE 'long' END AS distance_bucket FROM ST) "
        f"GROUP BY trip_year, distance_bucket",
        ("total_revenue", "avg_trip_value", "avg_fare_per_mile", "avg_distance"),
    ),
    "fact_trip_time_summary": (
        f"SELECT trip_year, pickup_month, pickup_day, pickup_hour, {REV}, "
        f"avg(trip_distance) AS avg_distance, avg(fare_per_mile) AS avg_fare_per_mile, "
        f"avg(passenger_count) AS avg_passengers FROM ST "
        f"GROUP BY trip_year, pickup_month, pickup_day, pickup_hour",
        ("total_revenue", "avg_trip_value", "avg_distance", "avg_fare_per_mile",
         "avg_passengers"),
    ),
    "fact_vendor_summary": (
        f"SELECT trip_year, vendor_id, {REV}, avg(trip_distance) AS avg_distance, "
        f"avg(fare_per_mile) AS avg_fare_per_mile, avg(passenger_count) AS avg_passengers, "
        f"{FEES} FROM ST GROUP BY trip_year, vendor_id",
        ("total_revenue", "avg_trip_value", "avg_distance", "avg_fare_per_mile",
         "avg_passengers", "total_airport_fee", "total_congestion_fee", "total_cbd_fee"),
    ),
}
FACT_CTES = {k: f"{k} AS ({sql})" for k, (sql, _) in FACT_SQL.items()}
for _k, (_sql, _dbl) in FACT_SQL.items():
    ORACLE[_k] = rounded(with_ctes(ST_CTES, _sql), _dbl)


# ------------------------------------------------------------- Platinum
HOURLY = """HD AS (
 SELECT pu_location_id, CAST(pickup_datetime AS DATE) AS trip_date, pickup_hour,
  count(*) AS trip_count, avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance,
  avg(passenger_count) AS avg_passengers
 FROM SH GROUP BY ALL)"""
ZONE_TOTALS = """ZT AS (
 SELECT pu_location_id, count(*) AS total_trips FROM SH
 WHERE pu_location_id IS NOT NULL GROUP BY pu_location_id)"""
THRESHOLD = "THR AS (SELECT quantile_cont(total_trips, 0.6) AS threshold FROM ZT)"
TOPZ = "TZ AS (SELECT ZT.* FROM ZT, THR WHERE total_trips >= threshold)"
BOUNDS = """BND AS (
 SELECT date_trunc('hour', min(pickup_datetime)) AS start_ts,
  date_trunc('hour', max(pickup_datetime)) AS end_ts FROM SH)"""
GRID = """GRID AS (
 SELECT pu_location_id, timestamp_hour, CAST(timestamp_hour AS DATE) AS trip_date,
  CAST(hour(timestamp_hour) AS INTEGER) AS pickup_hour
 FROM (SELECT TZ.pu_location_id,
        unnest(generate_series(BND.start_ts, BND.end_ts, INTERVAL 1 HOUR)) AS timestamp_hour
       FROM TZ, BND))"""
DENSE = """DENSE AS (
 SELECT g.pu_location_id, g.trip_date, g.pickup_hour, g.timestamp_hour,
  coalesce(d.trip_count, 0) AS trip_count, coalesce(d.avg_fare, 0.0) AS avg_fare,
  coalesce(d.avg_distance, 0.0) AS avg_distance, coalesce(d.avg_passengers, 0.0) AS avg_passengers
 FROM GRID g LEFT JOIN HD d USING (pu_location_id, trip_date, pickup_hour))"""
CAL = """CAL AS (
 SELECT *, CAST(dayofweek(trip_date) + 1 AS INTEGER) AS day_of_week,
  CAST(month(trip_date) AS INTEGER) AS month, CAST(year(trip_date) AS INTEGER) AS trip_year,
  CASE WHEN dayofweek(trip_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN pickup_hour BETWEEN 7 AND 10 OR pickup_hour BETWEEN 16 AND 19 THEN 1 ELSE 0 END AS is_rush_hour,
  CASE WHEN pickup_hour BETWEEN 22 AND 23 OR pickup_hour BETWEEN 0 AND 5 THEN 1 ELSE 0 END AS is_night
 FROM DENSE)"""
DS = """DS AS (
 SELECT *,
  lag(trip_count, 1) OVER w AS lag_1h, lag(trip_count, 24) OVER w AS lag_24h,
  lag(trip_count, 168) OVER w AS lag_168h
 FROM CAL WINDOW w AS (PARTITION BY pu_location_id ORDER BY trip_date, pickup_hour))"""
DS_CTES = [*SH_CTES, HOURLY, ZONE_TOTALS, THRESHOLD, TOPZ, BOUNDS, GRID, DENSE, CAL, DS]
DS_DOUBLES = ("avg_fare", "avg_distance", "avg_passengers")

ORACLE["demand_series"] = rounded(with_ctes(DS_CTES, "SELECT * FROM DS"), DS_DOUBLES)


def RE(x: str, n: int) -> str:
    """Half-to-even rounding on the decimal text (Spark's ``bround``)."""
    return f"CAST(round_even(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), {n}) AS DOUBLE)"


def add(name: str, ctes: list[str], body: str, doubles=()) -> None:
    ORACLE[name] = rounded(with_ctes(ctes, body), list(doubles))


def DIV(a: str, b: str) -> str:
    """Division that is NULL on a zero divisor, like Spark's try_divide."""
    return f"(CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END)"


# ------------------------------------------------------------- Silver steps
DECLARED_T = (
    "VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, "
    "RatecodeID, store_and_fwd_flag, PULocationID, DOLocationID, payment_type, fare_amount, "
    "extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount, "
    "congestion_surcharge, airport_fee"
)
T_DOUBLES = ("trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
             "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee",
             "cbd_congestion_fee")
TT = f"TT AS (SELECT {DECLARED_T}, CAST(NULL AS INTEGER) AS year, cbd_congestion_fee, source_file FROM T)"
TD = """TD AS (
 SELECT VendorID, tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
  coalesce(passenger_count, 1) AS passenger_count, trip_distance, coalesce(RatecodeID, 99) AS RatecodeID,
  coalesce(store_and_fwd_flag, 'N') AS store_and_fwd_flag, PULocationID, DOLocationID, payment_type,
  fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
  coalesce(congestion_surcharge, 0.0) AS congestion_surcharge, coalesce(airport_fee, 0.0) AS airport_fee,
  coalesce(cbd_congestion_fee, 0.0) AS cbd_congestion_fee, source_file
 FROM T)"""
RULES = ("fare_amount BETWEEN 3 AND 200 AND total_amount > 0 AND trip_distance BETWEEN 0.5 AND 100 "
         "AND passenger_count BETWEEN 1 AND 6 AND dropoff_datetime > pickup_datetime")
DUR = "CAST(floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime)) AS BIGINT)"

add("rename", [T], "SELECT VendorID AS vendor_id, tpep_pickup_datetime AS pickup_datetime, "
    "tpep_dropoff_datetime AS dropoff_datetime, PULocationID AS pu_location_id, "
    "DOLocationID AS do_location_id, RatecodeID AS ratecode_id FROM T")
add("fill_trip_defaults", [T, TD], "SELECT VendorID, pickup_datetime, passenger_count, RatecodeID, "
    "store_and_fwd_flag, congestion_surcharge, airport_fee, cbd_congestion_fee FROM TD",
    ("congestion_surcharge", "airport_fee", "cbd_congestion_fee"))
add("add_trip_flags", [T, TD], "SELECT VendorID, pickup_datetime, extra, mta_tax, tolls_amount, "
    "CASE WHEN airport_fee > 0 THEN 1 ELSE 0 END AS is_airport_trip, "
    "CASE WHEN cbd_congestion_fee > 0 THEN 1 ELSE 0 END AS is_cbd_trip, "
    "CASE WHEN extra + mta_tax + tolls_amount + congestion_surcharge > 0 THEN 1 ELSE 0 END AS has_extra_charges "
    "FROM TD", ("extra", "mta_tax", "tolls_amount"))
add("filter_valid_trips", [T, TD], "SELECT VendorID, pickup_datetime, dropoff_datetime, fare_amount, "
    f"total_amount, trip_distance, passenger_count FROM TD WHERE {RULES}",
    ("fare_amount", "total_amount", "trip_distance"))
add("add_calendar", [T, TD], "SELECT pickup_datetime, dropoff_datetime, CAST(dropoff_datetime AS DATE) AS trip_date, "
    "CAST(year(dropoff_datetime) AS INTEGER) AS trip_year, CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour, "
    "CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS pickup_day, CAST(month(pickup_datetime) AS INTEGER) AS pickup_month, "
    "CAST(year(pickup_datetime) AS INTEGER) AS pickup_year FROM TD")
add("add_extra_charges", [T, TD], f"SELECT total_amount, fare_amount, {R('total_amount - fare_amount', 2)} AS extra_charges FROM TD",
    ("total_amount", "fare_amount", "extra_charges"))
add("add_duration", [T, TD], f"SELECT pickup_datetime, dropoff_datetime, s AS trip_duration_seconds, "
    f"{R('s / 60', 2)} AS trip_duration_minutes FROM (SELECT *, {DUR} AS s FROM TD) WHERE s > 0",
    ("trip_duration_minutes",))
add("add_fare_per_mile", [T, TD], f"SELECT fare_amount, trip_distance, fpm AS fare_per_mile FROM "
    f"(SELECT *, {R('fare_amount / trip_distance', 2)} AS fpm FROM TD) WHERE fpm > 0 AND fpm < 100",
    ("fare_amount", "trip_distance", "fare_per_mile"))
add("add_distance_bucket", ST_CTES, "SELECT trip_distance, CASE WHEN trip_distance < 2 THEN 'short' "
    "WHEN trip_distance < 10 THEN 'medium' ELSE 'long' END AS distance_bucket FROM ST", ("trip_distance",))

# ------------------------------------------------------------- Bronze
TY = f"""TY AS (
 SELECT {DECLARED_T}, CAST(year(tpep_dropoff_datetime) AS INTEGER) AS year, cbd_congestion_fee, source_file FROM T)"""
VALID = "coalesce(year BETWEEN 1996 AND 2000, false)"
GOOD = f"GOOD AS (SELECT * FROM TY WHERE {VALID})"
BAD = f"BAD AS (SELECT * FROM TY WHERE NOT {VALID})"
REST_ORDER = ", ".join(
    f"{c} ASC NULLS FIRST" for c in (
        "passenger_count trip_distance RatecodeID store_and_fwd_flag PULocationID DOLocationID "
        "payment_type fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge "
        "total_amount congestion_surcharge airport_fee year cbd_congestion_fee").split())
DEDUP = f"""DEDUP AS (
 SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, source_file
                               ORDER BY {REST_ORDER}) AS rn FROM GOOD) WHERE rn = 1)"""
BRONZE_CTES = [T, TY, GOOD, BAD, DEDUP]

add("enforce_schema", [T, TT], "SELECT * FROM TT", T_DOUBLES)
add("normalise_columns", [T], "SELECT VendorID, tpep_pickup_datetime, passenger_count, airport_fee FROM T",
    ("airport_fee",))
add("add_ingest_metadata", [T], "SELECT VendorID, tpep_pickup_datetime, source_file, true AS has_ingestion_time FROM T")
add("with_partition_year", [T], "SELECT VendorID, tpep_dropoff_datetime, "
    "CAST(year(tpep_dropoff_datetime) AS INTEGER) AS year FROM T")
add("split_valid_good", BRONZE_CTES, "SELECT * FROM GOOD", T_DOUBLES)
add("split_valid_bad", BRONZE_CTES, "SELECT * FROM BAD", T_DOUBLES)
add("dedup_trips", BRONZE_CTES, "SELECT * FROM DEDUP", T_DOUBLES)
add("bronze_silver_yearly", [*BRONZE_CTES, *silver_ctes("SB", "DEDUP")],
    FACT_SQL["fact_trip_yearly_summary"][0].replace("FROM ST", "FROM SB"),
    FACT_SQL["fact_trip_yearly_summary"][1])
add("bronze_table", BRONZE_CTES, "SELECT * FROM DEDUP", T_DOUBLES)
add("quarantine_table", BRONZE_CTES, "SELECT * FROM BAD", T_DOUBLES)
add("read_landing", [T], f"SELECT {DECLARED_T.replace('tpep_pickup_datetime, tpep_dropoff_datetime', 'tpep_dropoff_datetime, tpep_pickup_datetime')}, "
    "cbd_congestion_fee, true AS has_source_file FROM T", T_DOUBLES)
add("read_landing_files", [T], f"SELECT {DECLARED_T}, cbd_congestion_fee FROM T", T_DOUBLES)
ORACLE["silver_table"] = ORACLE["silver_trips"]

# ------------------------------------------------------------- dimensions, facts
DL = """DL AS (SELECT CAST(LocationID AS INTEGER) AS location_id, Borough AS borough, Zone AS zone, service_zone FROM L)"""
add("dim_location", [L, DL], "SELECT * FROM DL")
ORACLE["read_zone_lookup"] = ORACLE["dim_location"]
ORACLE["write_dim"] = ORACLE["dim_location"]
ORACLE["write_fact"] = ORACLE["fact_trip_yearly_summary"]

# Dictionary rows (same as the Spark dimensions).
DP = """DP AS (SELECT * FROM (VALUES (0, 'Flex Fare'), (1, 'Credit Card'), (2, 'Cash'), (3, 'No charge'),
 (4, 'Dispute'), (5, 'Unknown'), (6, 'Voided trip')) v(payment_type, payment_name))"""
DV = """DV AS (SELECT * FROM (VALUES (1, 'Creative Mobile Technologies'), (2, 'Curb Mobility'),
 (6, 'Myle Technologies'), (7, 'Helix')) v(vendor_id, vendor_name))"""
FACTS_CTES = [*ST_CTES, *(f"{k} AS ({FACT_SQL[k][0]})" for k in FACT_SQL)]
EP = "EP AS (SELECT f.*, d.payment_name FROM fact_payment_summary f LEFT JOIN DP d USING (payment_type))"
EV = "EV AS (SELECT f.*, d.vendor_name FROM fact_vendor_summary f LEFT JOIN DV d USING (vendor_id))"
EL = """EL AS (SELECT f.*, d.borough, d.zone, d.service_zone FROM fact_location_summary f
 LEFT JOIN DL d ON f.pu_location_id = d.location_id)"""
HIST = [*FACTS_CTES, L, DL, DP, DV, EP, EV, EL]
FY_D = FACT_SQL["fact_trip_yearly_summary"][1]

add("filter_years", HIST, "SELECT * FROM fact_trip_yearly_summary WHERE trip_year IN (1995, 1996, 1997)", FY_D)
add("enrich_payment", HIST, "SELECT * FROM EP", FACT_SQL["fact_payment_summary"][1])
add("enrich_vendor", HIST, "SELECT * FROM EV", FACT_SQL["fact_vendor_summary"][1])
add("enrich_location", HIST, "SELECT * FROM EL", FACT_SQL["fact_location_summary"][1])
add("kpis", HIST, "SELECT CAST(sum(total_trips) AS BIGINT) AS total_trips, sum(total_revenue) AS total_revenue, "
    "avg(avg_trip_value) AS avg_trip_value, avg(avg_distance) AS avg_distance, "
    "avg(avg_fare_per_mile) AS avg_fare_per_mile FROM fact_trip_yearly_summary",
    ("total_revenue", "avg_trip_value", "avg_distance", "avg_fare_per_mile"))
add("kpis_weighted", HIST, "SELECT CAST(sum(total_trips) AS BIGINT) AS total_trips, sum(total_revenue) AS total_revenue, "
    f"{DIV('sum(total_revenue)', 'sum(total_trips)')} AS avg_trip_value, "
    f"{DIV('sum(avg_distance * total_trips)', 'sum(total_trips)')} AS avg_distance, "
    f"{DIV('sum(avg_fare_per_mile * total_trips)', 'sum(total_trips)')} AS avg_fare_per_mile "
    "FROM fact_trip_yearly_summary",
    ("total_revenue", "avg_trip_value", "avg_distance", "avg_fare_per_mile"))
add("yearly_trend", HIST, "SELECT * FROM fact_trip_yearly_summary", FY_D)
add("yoy_change", HIST, "SELECT trip_year, total_revenue, total_trips, "
    f"({DIV('total_revenue', 'lag(total_revenue) OVER (ORDER BY trip_year)')} - 1) * 100 AS revenue_change_pct, "
    f"({DIV('total_trips', 'lag(total_trips) OVER (ORDER BY trip_year)')} - 1) * 100 AS trips_change_pct "
    "FROM fact_trip_yearly_summary", ("total_revenue", "revenue_change_pct", "trips_change_pct"))
add("payment_mix", HIST, "SELECT *, total_trips / sum(total_trips) OVER () AS trip_share, "
    "CAST(row_number() OVER (ORDER BY total_trips DESC, payment_name) AS INTEGER) AS rank FROM "
    "(SELECT payment_name, CAST(sum(total_trips) AS BIGINT) AS total_trips FROM EP "
    "WHERE payment_name IS NOT NULL GROUP BY payment_name)", ("trip_share",))
add("payment_value", HIST, "SELECT payment_name, avg(avg_trip_value) AS avg_trip_value FROM EP "
    "WHERE payment_name IS NOT NULL GROUP BY payment_name", ("avg_trip_value",))
add("vendor_summary", HIST, "SELECT vendor_name, CAST(sum(total_trips) AS BIGINT) AS total_trips, "
    "sum(total_revenue) AS total_revenue, avg(avg_fare_per_mile) AS avg_fare_per_mile, "
    "avg(avg_passengers) AS avg_passengers FROM EV WHERE vendor_name IS NOT NULL GROUP BY vendor_name",
    ("total_revenue", "avg_fare_per_mile", "avg_passengers"))
DSUM = """DSUM AS (SELECT distance_bucket, CAST(sum(total_trips) AS BIGINT) AS total_trips,
 avg(avg_trip_value) AS avg_trip_value, avg(avg_fare_per_mile) AS avg_fpm,
 CAST(CASE distance_bucket WHEN 'short' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END AS INTEGER) AS bucket_order
 FROM fact_distance_summary GROUP BY distance_bucket)"""
add("distance_summary", [*HIST, DSUM], "SELECT * FROM DSUM", ("avg_trip_value", "avg_fpm"))
CAP = "upper(substr(b, 1, 1)) || lower(substr(b, 2))"
add("distance_highlights", [*HIST, DSUM],
    f"SELECT (SELECT {CAP} FROM (SELECT distance_bucket AS b FROM DSUM ORDER BY total_trips DESC, bucket_order LIMIT 1)) AS top_volume_bucket, "
    f"(SELECT {CAP} FROM (SELECT distance_bucket AS b FROM DSUM ORDER BY avg_fpm DESC, bucket_order LIMIT 1)) AS top_fpm_bucket")
HT_SUM = "SELECT pickup_hour, CAST(sum(total_trips) AS BIGINT) AS total_trips FROM fact_trip_time_summary GROUP BY pickup_hour"
add("hourly_trips", HIST, HT_SUM)
add("peak_hour", HIST, f"SELECT * FROM ({HT_SUM}) ORDER BY total_trips DESC, pickup_hour LIMIT 1")
add("borough_trips", HIST, "SELECT *, total_trips / sum(total_trips) OVER () AS trip_share, "
    "CAST(row_number() OVER (ORDER BY total_trips DESC, borough) AS INTEGER) AS borough_rank FROM "
    "(SELECT borough, CAST(sum(total_trips) AS BIGINT) AS total_trips FROM EL WHERE borough IS NOT NULL GROUP BY borough)",
    ("trip_share",))
add("top_zones_by_revenue", HIST, "SELECT zone, borough, sum(total_revenue) AS total_revenue, "
    "CAST(sum(total_trips) AS BIGINT) AS total_trips FROM EL WHERE zone IS NOT NULL AND borough IS NOT NULL "
    "GROUP BY zone, borough ORDER BY total_revenue DESC, zone, borough LIMIT 10", ("total_revenue",))
add("premium_zones", HIST, "SELECT zone, avg(avg_trip_value) AS avg_trip_value FROM EL WHERE zone IS NOT NULL "
    "GROUP BY zone ORDER BY avg_trip_value DESC, zone LIMIT 10", ("avg_trip_value",))

# ------------------------------------------------------------- Platinum pieces
add("zone_totals", DS_CTES, "SELECT * FROM ZT")
add("zone_threshold", DS_CTES, "SELECT threshold FROM THR", ("threshold",))
add("top_zones", DS_CTES, "SELECT * FROM TZ")
add("hour_bounds", DS_CTES, 'SELECT start_ts AS "start", end_ts AS "end" FROM BND')
add("hour_sequence", DS_CTES, "SELECT unnest(generate_series(start_ts, end_ts, INTERVAL 1 HOUR)) AS timestamp_hour FROM BND")
add("hourly_demand", DS_CTES, "SELECT * FROM HD", DS_DOUBLES)
add("hour_zone_grid", DS_CTES, "SELECT * FROM GRID")
add("semi_zones", DS_CTES, "SELECT pu_location_id, pickup_datetime, fare_amount FROM SH "
    "WHERE pu_location_id IN (SELECT pu_location_id FROM TZ)", ("fare_amount",))
add("densify", DS_CTES, "SELECT * FROM DENSE", DS_DOUBLES)
ORACLE["fill_missing_hours"] = ORACLE["densify"]
add("add_series_calendar", DS_CTES, "SELECT * FROM CAL", DS_DOUBLES)
add("add_lags", DS_CTES, "SELECT pu_location_id, trip_date, pickup_hour, trip_count, lag_1h, lag_24h, lag_168h FROM DS")
add("add_rolling_mean", DS_CTES, "SELECT pu_location_id, trip_date, pickup_hour, trip_count, "
    "avg(trip_count) OVER (PARTITION BY pu_location_id ORDER BY trip_date, pickup_hour "
    "ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS rolling_mean_24h FROM DS", ("rolling_mean_24h",))
ORACLE["order_series"] = ORACLE["demand_series"]
ORACLE["write_features"] = ORACLE["demand_series"]

# ------------------------------------------------------------- demand views
TS = "(CAST(trip_date AS TIMESTAMP) + pickup_hour * INTERVAL 1 HOUR)"
DSE = "DSE AS (SELECT DS.*, z.zone, z.borough FROM DS LEFT JOIN (SELECT location_id AS pu_location_id, zone, borough FROM DL) z USING (pu_location_id))"
DEM = [*DS_CTES, L, DL, DSE]
DAYTYPE = "CASE is_weekend WHEN 0 THEN 'Weekday' WHEN 1 THEN 'Weekend' END"

add("enrich_series", DEM, "SELECT * FROM DSE", DS_DOUBLES)
add("filter_zone", DEM, "SELECT * FROM DS WHERE pu_location_id = (SELECT min(pu_location_id) FROM DS)", DS_DOUBLES)
add("with_series_ts", DEM, f"SELECT pu_location_id, trip_date, pickup_hour, {TS} AS datetime FROM DS")
add("map_values", DEM, f"SELECT pu_location_id, trip_date, pickup_hour, is_weekend, {DAYTYPE} AS day_type, "
    "strftime(trip_date, '%a') AS dow_name, strftime(trip_date, '%b') AS month_name, "
    "strftime(trip_date, '%b %Y') AS month_label FROM DS")
add("distinct_sorted", DEM, "SELECT DISTINCT zone, pu_location_id FROM DSE WHERE zone IS NOT NULL AND pu_location_id IS NOT NULL")
add("hour_profile", DEM, f"SELECT *, {DAYTYPE} AS day_type, CASE WHEN row_number() OVER (PARTITION BY pu_location_id, is_weekend "
    "ORDER BY avg_trips DESC, pickup_hour) = 1 THEN 1 ELSE 0 END AS is_peak FROM "
    "(SELECT pu_location_id, pickup_hour, is_weekend, avg(trip_count) AS avg_trips FROM DS GROUP BY ALL)", ("avg_trips",))
TW = """TW AS (SELECT pu_location_id, CAST(isodow(trip_date) - 1 AS INTEGER) AS dow_num, strftime(trip_date, '%a') AS dow_name,
 pickup_hour, avg(trip_count) AS avg_trips FROM DS GROUP BY ALL)"""
add("typical_week", [*DEM, TW], "SELECT * FROM TW", ("avg_trips",))
add("week_extremes", [*DEM, TW], """SELECT b.pu_location_id, b.dow_name AS busiest_dow, b.pickup_hour AS busiest_hour,
 b.avg_trips AS busiest_avg_trips, q.dow_name AS quietest_dow, q.pickup_hour AS quietest_hour, q.avg_trips AS quietest_avg_trips
 FROM (SELECT *, row_number() OVER (PARTITION BY pu_location_id ORDER BY avg_trips DESC, dow_num, pickup_hour) AS r FROM TW) b
 JOIN (SELECT *, row_number() OVER (PARTITION BY pu_location_id ORDER BY avg_trips ASC, dow_num, pickup_hour) AS r FROM TW) q
 USING (pu_location_id) WHERE b.r = 1 AND q.r = 1""", ("busiest_avg_trips", "quietest_avg_trips"))
MS = """MS AS (SELECT *, strftime(make_date(2000, month, 1), '%b') AS month_name,
 CASE WHEN avg_trips >= avg(avg_trips) OVER (PARTITION BY pu_location_id) * 1.1 THEN 'peak'
      WHEN avg_trips <= avg(avg_trips) OVER (PARTITION BY pu_location_id) * 0.9 THEN 'trough'
      ELSE 'normal' END AS season_band
 FROM (SELECT pu_location_id, month, avg(trip_count) AS avg_trips FROM DS GROUP BY ALL))"""
add("season_band", [*DEM, MS], "SELECT * FROM MS", ("avg_trips",))
add("monthly_seasonality", [*DEM, MS], f"""SELECT p.pu_location_id, p.month_name AS peak_month, p.avg_trips AS peak_avg_trips,
 t.month_name AS trough_month, t.avg_trips AS trough_avg_trips,
 ({DIV('p.avg_trips', 't.avg_trips')} - 1) * 100 AS swing_pct
 FROM (SELECT *, row_number() OVER (PARTITION BY pu_location_id ORDER BY avg_trips DESC, month) AS r FROM MS) p
 JOIN (SELECT *, row_number() OVER (PARTITION BY pu_location_id ORDER BY avg_trips ASC, month) AS r FROM MS) t
 USING (pu_location_id) WHERE p.r = 1 AND t.r = 1""", ("peak_avg_trips", "trough_avg_trips", "swing_pct"))
add("borough_demand", DEM, "SELECT borough, avg(trip_count) AS avg_hourly FROM DSE WHERE borough IS NOT NULL GROUP BY borough",
    ("avg_hourly",))
add("zone_kpis", DEM, "SELECT pu_location_id, avg(trip_count) AS avg_demand, quantile_cont(trip_count, 0.95) AS p95_demand, "
    "avg(avg_fare) AS avg_fare, avg(avg_distance) AS avg_distance FROM DS GROUP BY pu_location_id",
    ("avg_demand", "p95_demand", "avg_fare", "avg_distance"))
add("yoy_monthly", DEM, "SELECT pu_location_id, CAST(year(trip_date) AS INTEGER) AS year, CAST(month(trip_date) AS INTEGER) AS month_num, "
    "strftime(trip_date, '%b') AS month_name, avg(trip_count) AS avg_trips FROM DS GROUP BY ALL", ("avg_trips",))
DOWS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
add("demand_heatmap", DEM, "SELECT pu_location_id, pickup_hour, " + ", ".join(
    f"avg(CASE WHEN strftime(trip_date, '%a') = '{d}' THEN trip_count END) AS \"{d}\"" for d in DOWS)
    + " FROM DS GROUP BY pu_location_id, pickup_hour", DOWS)
add("recent_monthly", DEM, "SELECT pu_location_id, month_start, avg_trips FROM (SELECT *, row_number() OVER "
    "(PARTITION BY pu_location_id ORDER BY month_start DESC) AS r FROM (SELECT pu_location_id, "
    "CAST(date_trunc('month', trip_date) AS DATE) AS month_start, avg(trip_count) AS avg_trips FROM DS GROUP BY ALL)) WHERE r <= 6",
    ("avg_trips",))
add("data_through", DEM, f"SELECT m AS data_through, strftime(m, '%B %Y') AS data_through_label FROM (SELECT max({TS}) AS m FROM DS)")
add("demand_hotspots", DEM, "SELECT pu_location_id, zone, borough, avg(trip_count) AS avg_hourly_demand FROM DSE "
    "WHERE zone IS NOT NULL AND borough IS NOT NULL GROUP BY ALL ORDER BY avg_hourly_demand DESC, pu_location_id LIMIT 20",
    ("avg_hourly_demand",))

# ------------------------------------------------------------- evaluation
LAGS_OK = "lag_1h IS NOT NULL AND lag_24h IS NOT NULL AND lag_168h IS NOT NULL"
DST = f"DST AS (SELECT *, {TS} AS datetime FROM DS)"
CUT = "(SELECT max(datetime) - INTERVAL 7 DAY FROM DST)"
TEST = f"TEST AS (SELECT * FROM DST WHERE datetime > {CUT} AND {LAGS_OK})"
NP = """NP AS (SELECT pu_location_id, datetime, trip_count, greatest(CAST(lag_168h AS DOUBLE), 0.0) AS prediction,
 is_rush_hour, is_weekend, pickup_hour FROM TEST)"""
EVAL = [*DS_CTES, DST, TEST, NP]
BUCKET = ("CASE WHEN trip_count <= 10 THEN 'very low (<10)' WHEN trip_count <= 50 THEN 'low (10–50)' "
          "WHEN trip_count <= 200 THEN 'medium (50–200)' ELSE 'high (200+)' END")
BUCKET_ORDER = ("CAST(CASE WHEN trip_count <= 10 THEN 0 WHEN trip_count <= 50 THEN 1 "
                "WHEN trip_count <= 200 THEN 2 ELSE 3 END AS INTEGER)")
APE = "abs(trip_count - prediction) / CASE WHEN trip_count = 0 THEN 1 ELSE trip_count END"
R2 = ("CASE WHEN count(trip_count) < 2 THEN NULL WHEN var_pop(trip_count) * count(trip_count) = 0 THEN "
      "CASE WHEN sum((trip_count - prediction) * (trip_count - prediction)) = 0 THEN 1.0 ELSE 0.0 END "
      "ELSE 1 - sum((trip_count - prediction) * (trip_count - prediction)) / (var_pop(trip_count) * count(trip_count)) END")
METRICS = {
    "mae": "avg(abs(trip_count - prediction))",
    "rmse": "sqrt(avg((trip_count - prediction) * (trip_count - prediction)))",
    "r2": R2,
    "mape": f"avg({APE}) * 100",
}
PRED_D = ("prediction",)

add("drop_warmup", DS_CTES, f"SELECT * FROM DS WHERE {LAGS_OK}", DS_DOUBLES)
add("time_split_train", [*DS_CTES, DST], f"SELECT * FROM DST WHERE datetime <= {CUT} AND {LAGS_OK}", DS_DOUBLES)
add("time_split_test", EVAL, "SELECT * FROM TEST", DS_DOUBLES)
add("seasonal_naive", EVAL, "SELECT * FROM NP", PRED_D)
add("clip_nonneg", DS_CTES, "SELECT pu_location_id, trip_date, pickup_hour, "
    "CASE WHEN trip_count < lag_168h THEN 0.0 ELSE CAST(trip_count - lag_168h AS DOUBLE) END AS growth FROM DS", ("growth",))
add("add_demand_bucket", EVAL, f"SELECT *, {BUCKET} AS demand_bucket, {BUCKET_ORDER} AS bucket_order FROM NP", PRED_D)
add("forecast_metrics", EVAL, "SELECT count(*) AS n, " + ", ".join(f"{v} AS {k}" for k, v in METRICS.items())
    + " FROM NP", tuple(METRICS))
add("mape_by_bucket", EVAL, """SELECT b.bucket_order, b.demand_bucket, m.mape FROM
 (SELECT * FROM (VALUES (0, 'very low (<10)'), (1, 'low (10–50)'), (2, 'medium (50–200)'), (3, 'high (200+)'))
  v(bucket_order, demand_bucket)) b LEFT JOIN """
    f"(SELECT {BUCKET_ORDER} AS bucket_order, avg({APE}) * 100 AS mape FROM NP GROUP BY 1) m USING (bucket_order)",
    ("mape",))
ZM_PLACES = {"mae": 2, "rmse": 2, "r2": 4, "mape": 2}
ZM = ("SELECT pu_location_id AS zone_id, " + ", ".join(f"{RE(METRICS[k], n)} AS {k}" for k, n in ZM_PLACES.items())
      + " FROM NP GROUP BY pu_location_id")
add("zone_metrics", EVAL, ZM, tuple(ZM_PLACES))
# The model's features, zone first.
FEATURES = ("pu_location_id", "pickup_hour", "day_of_week", "month", "trip_year", "is_weekend", "is_rush_hour", "is_night",
            "lag_1h", "lag_24h", "lag_168h", "avg_fare", "avg_distance", "avg_passengers")
NAMES = ", ".join(f"('{f}')" for f in FEATURES)
ORACLE["write_evaluation"] = (f"SELECT *, 'predictions' AS evaluation FROM ({ORACLE['seasonal_naive']}) a UNION ALL BY NAME "
    f"SELECT *, 'metrics' AS evaluation FROM ({ORACLE['zone_metrics']}) b UNION ALL BY NAME "
    f"SELECT feature, true AS is_share, 'importance' AS evaluation FROM (VALUES {NAMES}) v(feature)")
add("actual_vs_predicted", EVAL, "SELECT datetime, trip_count, prediction FROM NP "
    "WHERE pu_location_id = (SELECT min(pu_location_id) FROM NP)", PRED_D)

# ------------------------------------------------------------- forecast roll-ups
START = f"(SELECT max({TS}) + INTERVAL 1 HOUR FROM DS)"
add("future_grid", DS_CTES, f"""SELECT pu_location_id, datetime, CAST(datetime AS DATE) AS trip_date,
 CAST(hour(datetime) AS INTEGER) AS pickup_hour,
 CAST(dayofweek(datetime) + 1 AS INTEGER) AS day_of_week, CAST(month(datetime) AS INTEGER) AS month,
 CAST(year(datetime) AS INTEGER) AS trip_year,
 CASE WHEN dayofweek(datetime) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
 CASE WHEN hour(datetime) BETWEEN 7 AND 10 OR hour(datetime) BETWEEN 16 AND 19 THEN 1 ELSE 0 END AS is_rush_hour,
 CASE WHEN hour(datetime) BETWEEN 22 AND 23 OR hour(datetime) BETWEEN 0 AND 5 THEN 1 ELSE 0 END AS is_night
 FROM (SELECT z.pu_location_id, unnest(generate_series({START}, {START} + INTERVAL 2159 HOUR, INTERVAL 1 HOUR)) AS datetime
       FROM (SELECT DISTINCT pu_location_id FROM DS) z)""")
SEED = """SEED AS (SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY pu_location_id
 ORDER BY trip_date DESC, pickup_hour DESC) AS r FROM DS) WHERE r <= {n})"""
add("seed_rows", [*DS_CTES, SEED.format(n=500)], "SELECT * FROM SEED", DS_DOUBLES)
add("seed_averages", [*DS_CTES, SEED.format(n=24)], "SELECT pu_location_id, avg(avg_fare) AS avg_fare, "
    "avg(avg_distance) AS avg_distance, avg(avg_passengers) AS avg_passengers FROM SEED GROUP BY pu_location_id", DS_DOUBLES)
HF = f"HF AS (SELECT pu_location_id, {TS} AS datetime, trip_count FROM DS)"
add("weekly_projection", [*DS_CTES, HF], "SELECT pu_location_id, CAST(date_trunc('week', datetime) AS DATE) AS week_start, "
    "avg(trip_count) AS avg_trips FROM HF GROUP BY ALL", ("avg_trips",))
DR = f"""DR AS (SELECT *, CAST({RE('avg_hourly_demand / 2.0', 0)} AS INTEGER) AS avg_drivers,
 CAST({RE('avg_hourly_demand * 1.5 / 2.0', 0)} AS INTEGER) AS peak_drivers,
 strftime(month_start, '%b %Y') AS month_label
 FROM (SELECT pu_location_id, CAST(date_trunc('month', datetime) AS DATE) AS month_start,
       avg(trip_count) AS avg_hourly_demand FROM HF GROUP BY ALL))"""
add("driver_requirement", [*DS_CTES, HF, DR], "SELECT * FROM DR", ("avg_hourly_demand",))
add("driver_summary", [*DS_CTES, HF, DR], "SELECT pu_location_id, CAST(floor(avg(avg_drivers)) AS INTEGER) AS avg_drivers, "
    "max(peak_drivers) AS max_peak_drivers FROM DR GROUP BY pu_location_id")

# ------------------------------------------------------------- files, profiling
add("landing_progress", [T], """SELECT latest_month, CAST(coalesce(latest_month + INTERVAL 1 MONTH, DATE '2025-01-01') AS DATE) AS next_month,
 strftime(latest_month, '%Y-%m') AS latest_label,
 strftime(coalesce(latest_month + INTERVAL 1 MONTH, DATE '2025-01-01'), '%Y-%m') AS next_label
 FROM (SELECT CAST(max(date_trunc('month', tpep_dropoff_datetime)) AS DATE) AS latest_month FROM T)""")
add("row_counts", [*BRONZE_CTES, *silver_ctes("ST", "T"), *DS_CTES],
    "SELECT 'landing' AS stage, count(*) AS row_count FROM T UNION ALL SELECT 'bronze', count(*) FROM DEDUP "
    "UNION ALL SELECT 'silver', count(*) FROM ST UNION ALL SELECT 'platinum', count(*) FROM DS")
# The number and string columns of the declared trip schema.
NUMBERS = ("VendorID passenger_count trip_distance RatecodeID PULocationID DOLocationID payment_type fare_amount extra mta_tax "
           "tip_amount tolls_amount improvement_surcharge total_amount congestion_surcharge airport_fee year cbd_congestion_fee").split()
STRINGS = ("store_and_fwd_flag", "source_file")
NO_NUMBER = "CAST(NULL AS DOUBLE)"
add("profile_describe", [T, TT], " UNION ALL ".join(
    [f"SELECT '{c}' AS \"column\", count({c}) AS count, avg({c}::DOUBLE) AS mean, stddev_samp({c}::DOUBLE) AS stddev, "
     f"min({c}::DOUBLE) AS min, max({c}::DOUBLE) AS max, CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM TT" for c in NUMBERS]
    + [f"SELECT '{c}', count({c}), {NO_NUMBER}, {NO_NUMBER}, {NO_NUMBER}, {NO_NUMBER}, min({c}), max({c}) FROM TT" for c in STRINGS]),
    ("mean", "stddev", "min", "max"))
add("profile_summary", ST_CTES, "SELECT count(fare_per_mile) AS count, avg(fare_per_mile) AS mean, stddev_samp(fare_per_mile) AS stddev, "
    "min(fare_per_mile) AS min, max(fare_per_mile) AS max, true AS q25_ok, true AS q50_ok, true AS q75_ok FROM ST",
    ("mean", "stddev", "min", "max"))
DECLARED_COLUMNS = (*NUMBERS, "tpep_pickup_datetime", "tpep_dropoff_datetime", *STRINGS)
add("profile_distinct", [T, TT], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values, true AS estimate_ok FROM TT" for c in DECLARED_COLUMNS))

FOLDERS = "SELECT DISTINCT coalesce('year=' || CAST(year(tpep_dropoff_datetime) AS VARCHAR), 'year=__HIVE_DEFAULT_PARTITION__') AS folder FROM T"
add("new_files", [T], f"SELECT * FROM ({FOLDERS}) f WHERE folder <> 'year=1992'")
add("file_ledger", [T], f"SELECT folder, CAST(1 AS BIGINT) AS times_listed, true AS not_after_latest FROM ({FOLDERS}) f")
ORACLE["stream_bronze"] = f"SELECT * EXCLUDE (source_file) FROM ({ORACLE['dedup_trips']}) d"
ORACLE["stream_replay"] = ORACLE["stream_bronze"]
ORACLE["mixed_loads"] = ORACLE["stream_bronze"]
ORACLE["stream_quarantine"] = f"SELECT * EXCLUDE (source_file) FROM ({ORACLE['quarantine_table']}) d"

# ------------------------------------------------------------- model: keys, and flags that must hold
TRAIN = f"TRAIN AS (SELECT * FROM DST WHERE datetime <= {CUT} AND {LAGS_OK})"
ZONE_NUMBER = "ZN AS (SELECT z, CAST(row_number() OVER (ORDER BY z) - 1 AS DOUBLE) AS zone_index FROM (SELECT DISTINCT CAST(pu_location_id AS VARCHAR) AS z FROM TRAIN))"
F_COLS = ", ".join("zone_index AS f_pu_location_id" if f == "pu_location_id" else f"CAST({f} AS DOUBLE) AS f_{f}" for f in FEATURES)
add("feature_pipeline", [*DS_CTES, DST, TRAIN, ZONE_NUMBER], "SELECT pu_location_id, trip_date, pickup_hour, zone_index, "
    f"{F_COLS} FROM TRAIN JOIN ZN ON z = CAST(pu_location_id AS VARCHAR)", ("zone_index", *(f"f_{f}" for f in FEATURES)))
add("train_demand_model", [], "SELECT true AS stopped_by_patience, true AS below_bound, true AS none_is_better, true AS cut_at_best, true AS better_than_any_constant")
add("score", EVAL, "SELECT pu_location_id, trip_date, pickup_hour, trip_count, true AS not_negative, true AS better_than_any_constant FROM TEST")
add("feature_importance", [], f"SELECT feature, true AS not_negative, true AS sums_to_one, true AS effect_agrees FROM (VALUES {NAMES}) v(feature)")
add("save_load_model", EVAL, "SELECT pu_location_id, trip_date, pickup_hour, true AS same FROM TEST")
ORACLE["forecast"] = f"SELECT pu_location_id, datetime, true AS not_negative, true AS lags_match, true AS model_agrees FROM ({ORACLE['future_grid']}) g"
ORACLE["forecast_weekly"] = ("SELECT pu_location_id, CAST(date_trunc('week', datetime) AS DATE) AS week_start, count(*) AS hours, "
    f"true AS adds_up, true AS peak_covers_mean FROM ({ORACLE['future_grid']}) g GROUP BY ALL")

# ------------------------------------------------------------- all facts as one table


def all_facts(source: str) -> str:
    """Six facts of different columns over the Silver relation ``source``."""
    return " UNION ALL BY NAME ".join(
        "SELECT *, '" + k + "' AS fact FROM (" + rounded(sql.replace("FROM ST", f"FROM {source}"), list(doubles)) + f") f_{k}"
        for k, (sql, doubles) in FACT_SQL.items())


RATES = "(1, 'Standard'), (2, 'JFK'), (3, 'Newark'), (4, 'Nassau/Westchester'), (5, 'Negotiated fare'), (6, 'Group ride'), (99, 'Unknown')"
add("rate_summary", ST_CTES, f"""SELECT trip_year, ratecode_id, rate_name, store_flag_desc, count(*) AS total_trips, sum(total_amount) AS total_revenue, avg(fare_amount) AS avg_fare
FROM ST LEFT JOIN (VALUES {RATES}) r(code, rate_name) ON ratecode_id = code
LEFT JOIN (VALUES ('Y', 'Stored and forwarded'), ('N', 'Sent directly')) f(flag, store_flag_desc) ON store_and_fwd_flag = flag
GROUP BY ALL""", ("total_revenue", "avg_fare"))
ORACLE["fact_grouping_sets"] = with_ctes(ST_CTES, all_facts("ST"))
ORACLE["medallion_gold"] = with_ctes([*BRONZE_CTES, *silver_ctes("SB", "DEDUP")], all_facts("SB"))
ORACLE["live_facts"] = ORACLE["medallion_gold"]
ORACLE["live_series"] = ORACLE["demand_series"]
add("live_silver", [*BRONZE_CTES, *silver_ctes("SB", "DEDUP")], f"SELECT {SILVER_COLS} FROM SB", SILVER_DOUBLES)
add("live_row_counts", BRONZE_CTES, "SELECT 'bronze' AS stage, count(*) AS row_count FROM DEDUP UNION ALL SELECT 'quarantine', count(*) FROM BAD")
add("live_profile", BRONZE_CTES, " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS rows, count(DISTINCT {c}) AS distinct_values, true AS same_rows, true AS estimate_ok, "
    "true AS quartiles_ok, true AS has_quartiles FROM DEDUP" for c in DECLARED_COLUMNS if c != "source_file"))
add("drop", [T, TT], "SELECT * EXCLUDE (source_file) FROM TT", T_DOUBLES)
add("payment_value_weighted", HIST, "SELECT payment_name, "
    f"{DIV('sum(total_revenue)', 'sum(total_trips)')} AS avg_trip_value FROM EP "
    "WHERE payment_name IS NOT NULL GROUP BY payment_name", ("avg_trip_value",))
