"""Gold: dimensions and the six fact aggregates over Silver.

Each fact is one ``groupBy().agg()``: a partial aggregate per map task, one
shuffle of at most (keys x tasks) rows, a final aggregate. The six facts read
Silver once when the caller persists it or reads it from its table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The data-dictionary rows for the small dimensions.
VENDORS = [
    (1, "Creative Mobile Technologies"),
    (2, "Curb Mobility"),
    (6, "Myle Technologies"),
    (7, "Helix"),
]
RATE_CODES = [
    (1, "Standard"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau/Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (99, "Unknown"),
]
PAYMENT_TYPES = [
    (0, "Flex Fare"),
    (1, "Credit Card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
STORE_FLAGS = [
    ("Y", "Stored and forwarded"),
    ("N", "Sent directly"),
]

# Distance bucket edges in miles (< 2 short, < 10 medium).
DISTANCE_EDGES = (2, 10)
DISTANCE_ORDER = ("short", "medium", "long")

ZONE_LOOKUP_DDL = "LocationID INT, Borough STRING, Zone STRING, service_zone STRING"


def dim_vendor(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(VENDORS, "vendor_id BIGINT, vendor_name STRING")


def dim_rate_code(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RATE_CODES, "rate_code_id BIGINT, rate_name STRING")


def dim_payment_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PAYMENT_TYPES, "payment_type BIGINT, payment_name STRING")


def dim_store_forward_flag(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        STORE_FLAGS, "store_and_fwd_flag STRING, store_flag_desc STRING"
    )


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with a header row, read with a declared schema (no
    inference pass over the file)."""
    return spark.read.schema(ZONE_LOOKUP_DDL).option("header", True).csv(path)


def dim_location(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("LocationID").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        F.col("service_zone"),
    )


def add_distance_bucket(df: DataFrame, col: str = "trip_distance") -> DataFrame:
    short, medium = DISTANCE_EDGES
    bucket = (
        F.when(F.col(col) < short, "short")
        .when(F.col(col) < medium, "medium")
        .otherwise("long")
    )
    return df.withColumn("distance_bucket", bucket)


def _trips() -> Column:
    return F.count(F.lit(1)).alias("total_trips")


def _revenue() -> list[Column]:
    return [
        F.sum("total_amount").alias("total_revenue"),
        F.avg("total_amount").alias("avg_trip_value"),
    ]


def _fees() -> list[Column]:
    return [
        F.sum("airport_fee").alias("total_airport_fee"),
        F.sum("congestion_surcharge").alias("total_congestion_fee"),
        F.sum("cbd_congestion_fee").alias("total_cbd_fee"),
    ]


def fact_trip_yearly_summary(trips: DataFrame) -> DataFrame:
    return trips.groupBy("trip_year").agg(
        _trips(),
        *_revenue(),
        F.sum("trip_distance").alias("total_distance"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("fare_per_mile").alias("avg_fare_per_mile"),
        F.avg("passenger_count").alias("avg_passengers"),
        *_fees(),
    )


def fact_payment_summary(trips: DataFrame) -> DataFrame:
    return trips.groupBy("trip_year", "payment_type").agg(
        _trips(), *_revenue(), F.avg("fare_per_mile").alias("avg_fare_per_mile")
    )


def fact_location_summary(trips: DataFrame) -> DataFrame:
    return trips.groupBy("trip_year", "pu_location_id").agg(
        _trips(),
        *_revenue(),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("fare_per_mile").alias("avg_fare_per_mile"),
    )


def fact_distance_summary(trips: DataFrame) -> DataFrame:
    return (
        add_distance_bucket(trips)
        .groupBy("trip_year", "distance_bucket")
        .agg(
            _trips(),
            *_revenue(),
            F.avg("fare_per_mile").alias("avg_fare_per_mile"),
            F.avg("trip_distance").alias("avg_distance"),
        )
    )


def fact_trip_time_summary(trips: DataFrame) -> DataFrame:
    return trips.groupBy("trip_year", "pickup_month", "pickup_day", "pickup_hour").agg(
        _trips(),
        *_revenue(),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("fare_per_mile").alias("avg_fare_per_mile"),
        F.avg("passenger_count").alias("avg_passengers"),
    )


def fact_vendor_summary(trips: DataFrame) -> DataFrame:
    return trips.groupBy("trip_year", "vendor_id").agg(
        _trips(),
        *_revenue(),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("fare_per_mile").alias("avg_fare_per_mile"),
        F.avg("passenger_count").alias("avg_passengers"),
        *_fees(),
    )


FACTS = {
    "fact_trip_yearly_summary": fact_trip_yearly_summary,
    "fact_payment_summary": fact_payment_summary,
    "fact_location_summary": fact_location_summary,
    "fact_distance_summary": fact_distance_summary,
    "fact_trip_time_summary": fact_trip_time_summary,
    "fact_vendor_summary": fact_vendor_summary,
}


# Keys of each fact, in the order of the grouping sets below.
FACT_KEYS = {
    "fact_trip_yearly_summary": ("trip_year",),
    "fact_payment_summary": ("trip_year", "payment_type"),
    "fact_location_summary": ("trip_year", "pu_location_id"),
    "fact_distance_summary": ("trip_year", "distance_bucket"),
    "fact_trip_time_summary": ("trip_year", "pickup_month", "pickup_day", "pickup_hour"),
    "fact_vendor_summary": ("trip_year", "vendor_id"),
}
_ALL_KEYS = list(dict.fromkeys(k for keys in FACT_KEYS.values() for k in keys))


def fact_grouping_sets(trips: DataFrame) -> DataFrame:
    """All six facts in one pass over Silver.

    One ``GROUPING SETS`` aggregate (one scan, one partial aggregate per map
    task, one shuffle) replaces six scans of the trip table. ``gid`` tells the
    sets apart, so a NULL key in the data is never confused with a key that
    is absent from a set. The result is the size of the six facts together.
    """
    sets = [[F.col(k) for k in keys] for keys in FACT_KEYS.values()]
    return (
        add_distance_bucket(trips)
        .groupingSets(sets, *_ALL_KEYS)
        .agg(
            F.grouping_id(*_ALL_KEYS).alias("gid"),
            _trips(),
            *_revenue(),
            F.sum("trip_distance").alias("total_distance"),
            F.avg("trip_distance").alias("avg_distance"),
            F.avg("fare_per_mile").alias("avg_fare_per_mile"),
            F.avg("passenger_count").alias("avg_passengers"),
            *_fees(),
        )
    )


def _gid(keys) -> int:
    """grouping_id value of a set: bit i (from the left) is 1 when key i is
    not grouped."""
    n = len(_ALL_KEYS)
    return sum(1 << (n - 1 - i) for i, k in enumerate(_ALL_KEYS) if k not in keys)


# Measures of each fact, in its builder's column order.
_REV = ("total_trips", "total_revenue", "avg_trip_value")
_FEES = ("total_airport_fee", "total_congestion_fee", "total_cbd_fee")
FACT_MEASURES = {
    "fact_trip_yearly_summary": (*_REV, "total_distance", "avg_distance", "avg_fare_per_mile",
                                 "avg_passengers", *_FEES),
    "fact_payment_summary": (*_REV, "avg_fare_per_mile"),
    "fact_location_summary": (*_REV, "avg_distance", "avg_fare_per_mile"),
    "fact_distance_summary": (*_REV, "avg_fare_per_mile", "avg_distance"),
    "fact_trip_time_summary": (*_REV, "avg_distance", "avg_fare_per_mile", "avg_passengers"),
    "fact_vendor_summary": (*_REV, "avg_distance", "avg_fare_per_mile", "avg_passengers", *_FEES),
}


def split_facts(agg: DataFrame) -> dict:
    """The six fact tables out of ``fact_grouping_sets``, each with the same
    columns as its single-fact builder."""
    return {
        name: agg.filter(F.col("gid") == _gid(keys)).select(*keys, *FACT_MEASURES[name])
        for name, keys in FACT_KEYS.items()
    }


# ------------------------------------------------------------ additive state
# What the facts need, as sums: they add up over any split of the trips.
SUMMED = ("total_amount", "trip_distance", "fare_per_mile", "passenger_count", "airport_fee", "congestion_surcharge", "cbd_congestion_fee")
AVERAGED = {"avg_trip_value": "total_amount", "avg_distance": "trip_distance", "avg_fare_per_mile": "fare_per_mile", "avg_passengers": "passenger_count"}
TOTALLED = {
    "total_revenue": "total_amount", "total_distance": "trip_distance", "total_airport_fee": "airport_fee",
    "total_congestion_fee": "congestion_surcharge", "total_cbd_fee": "cbd_congestion_fee",
}


def fact_state(trips: DataFrame, load: str = "load_id") -> DataFrame:
    """The six facts of each load as sums and counts, in one pass: rows
    (load, keys, gid). States of different loads add up to the facts of all."""
    keys = [load, *_ALL_KEYS]
    sets = [[F.col(k) for k in (load, *own)] for own in FACT_KEYS.values()]
    sums = [f(c).alias(f"{n}_{c}") for c in SUMMED for n, f in (("sum", F.sum), ("n", F.count))]
    return add_distance_bucket(trips).groupingSets(sets, *keys).agg(F.grouping_id(*keys).alias("gid"), _trips(), *sums)


def merge_facts(state: DataFrame) -> DataFrame:
    """``fact_grouping_sets`` of all trips, from the states of their loads."""
    added = state.groupBy(*_ALL_KEYS, "gid").agg(*[F.sum(c).alias(c) for c in ("total_trips", *(f"{n}_{c}" for c in SUMMED for n in ("sum", "n")))])
    mean = lambda c: F.try_divide(F.col(f"sum_{c}"), F.col(f"n_{c}"))
    return added.select(
        *_ALL_KEYS, "gid", "total_trips",
        *[F.col(f"sum_{c}").alias(name) for name, c in TOTALLED.items()], *[mean(c).alias(name) for name, c in AVERAGED.items()],
    )
