"""Stand-in trip inputs derived from the driver's TPC-H-style tables.

Each view is one SQL text that runs unchanged on Spark and on DuckDB, so the
Spark operators and the DuckDB oracle start from identical rows:

* ``T``: multi-year trips from ``lineitem`` (Bronze, Silver, Gold, history).
* ``H``: 30 days of hourly trips from ``events`` x ``customer`` (Platinum,
  demand views, model, forecast).
* ``L``: zone lookup from ``nation`` x ``region``.

Money is built with ``floor`` so no value sits on a rounding tie. In Spark the
table names are bound as DataFrame parameters (``{lineitem}``), so no session
state (temp views) is touched and the scans keep column pruning and pushdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.session import ensure_conf

# The fixture definitions (same text for both engines).
TRIPS_SQL = """
SELECT
 CAST(CASE WHEN l_orderkey % 13 = 0 THEN 9 WHEN l_returnflag='A' THEN 1 WHEN l_returnflag='N' THEN 2 ELSE 6 END AS BIGINT) AS VendorID,
 CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_shipdate + INTERVAL '1' HOUR * (l_partkey % 24) END AS tpep_dropoff_datetime,
 CASE WHEN l_orderkey % 89 = 0 THEN l_shipdate + INTERVAL '1' HOUR * (l_partkey % 24 + 1)
      ELSE l_shipdate + INTERVAL '1' HOUR * (l_partkey % 24) - INTERVAL '1' MINUTE * (2 * CAST(l_quantity AS INT)) END AS tpep_pickup_datetime,
 CAST(CASE WHEN l_orderkey % 10 = 0 THEN NULL WHEN l_orderkey % 17 = 0 THEN l_linenumber - 1 ELSE l_linenumber END AS BIGINT) AS passenger_count,
 l_quantity / 4 AS trip_distance,
 CAST(CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE 1 + l_partkey % 6 END AS BIGINT) AS RatecodeID,
 CASE WHEN l_suppkey % 9 = 0 THEN NULL WHEN l_linestatus = 'F' THEN 'N' ELSE 'Y' END AS store_and_fwd_flag,
 CAST(l_suppkey % 26 AS BIGINT) AS PULocationID,
 CAST(l_partkey % 25 AS BIGINT) AS DOLocationID,
 CAST(l_partkey % 7 AS BIGINT) AS payment_type,
 CAST(floor(l_extendedprice / 5) AS DOUBLE) / 100 AS fare_amount,
 CAST(l_partkey % 3 AS DOUBLE) / 2 AS extra,
 CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE CAST(0.5 AS DOUBLE) END AS mta_tax,
 CAST(floor(l_discount * l_extendedprice / 5) AS DOUBLE) / 100 AS tip_amount,
 CASE WHEN l_suppkey % 5 = 0 THEN CAST(6.94 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS tolls_amount,
 CAST(1 AS DOUBLE) AS improvement_surcharge,
 CAST(floor(l_extendedprice / 5) + floor(l_discount * l_extendedprice / 5) + 100 AS DOUBLE) / 100 AS total_amount,
 CASE WHEN l_linenumber = 3 THEN NULL WHEN l_linestatus = 'O' THEN CAST(2.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS congestion_surcharge,
 CASE WHEN l_linenumber = 5 THEN NULL WHEN l_discount >= 0.09 THEN CAST(1.75 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS airport_fee,
 CASE WHEN l_linenumber = 2 THEN NULL WHEN l_tax >= 0.05 THEN CAST(0.75 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS cbd_congestion_fee,
 concat('trips_', CAST(year(l_shipdate) AS VARCHAR(4)), '.parquet') AS source_file
FROM {lineitem}
"""

HOURLY_SQL = """
SELECT
 CAST(1 + user_id % 2 AS BIGINT) AS VendorID, ts AS tpep_pickup_datetime,
 ts + INTERVAL '30' SECOND * (event_id % 100) AS tpep_dropoff_datetime,
 CAST(CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_id % 8 END AS BIGINT) AS passenger_count,
 CAST(event_id % 96 AS DOUBLE) / 8 AS trip_distance, CAST(c_nationkey AS BIGINT) AS PULocationID,
 value AS fare_amount, value + 1 AS total_amount
FROM {events} JOIN {customer} ON user_id = c_custkey
"""

ZONES_SQL = """
SELECT CAST(n_nationkey AS INT) AS LocationID, r_name AS Borough, n_name AS Zone, 'Zone' AS service_zone
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

# Valid dropoff years for the Bronze split on fixture T (the reference's own
# production range is 2025-2026).
TRIPS_VALID_YEARS = (1996, 2000)

FIXTURE_TABLES = {
    "T": ("lineitem",),
    "H": ("events", "customer"),
    "L": ("nation", "region"),
}
_FIXTURE_SQL = {"T": TRIPS_SQL, "H": HOURLY_SQL, "L": ZONES_SQL}

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fixture(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    ensure_conf(spark)
    tables = {t: table(spark, sf_dir, t) for t in FIXTURE_TABLES[key]}
    return spark.sql(_FIXTURE_SQL[key], **tables)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture ``T`` as landed (timestamps still ``TIMESTAMP_NTZ``)."""
    return _fixture(spark, sf_dir, "T")


def raw_hourly_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture ``H`` as landed: a sparse trip file lacking most columns."""
    return _fixture(spark, sf_dir, "H")


def raw_zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture ``L``: the zone lookup with the CSV's column names."""
    return _fixture(spark, sf_dir, "L")


def duckdb_fixture_sql(key: str) -> str:
    """The same fixture text with plain table names, for the DuckDB oracle."""
    return _FIXTURE_SQL[key].format(**{t: t for t in FIXTURE_TABLES[key]})
