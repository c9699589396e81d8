"""Lazy building blocks shared by the registered queries.

Every block is a plain DataFrame plan over the driver's tables; nothing is
collected. ``T`` plays the landed trip files (and, typed, the Bronze table),
``H`` the hourly trips behind Platinum, ``L`` the zone lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.operators import bronze, gold, platinum, silver
from tripflow.sources import fixtures


def typed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture ``T`` after schema enforcement (declared types, missing
    declared columns as typed NULL)."""
    return bronze.enforce_schema(fixtures.raw_trips(spark, sf_dir))


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver over ``T`` treated as the Bronze table (every year kept)."""
    return silver.silver_transform(typed_trips(spark, sf_dir))


def typed_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.enforce_schema(fixtures.raw_hourly_trips(spark, sf_dir))


def silver_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_transform(typed_hourly(spark, sf_dir))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dim_location`` built from fixture ``L``."""
    return gold.dim_location(fixtures.raw_zone_lookup(spark, sf_dir))


def demand_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return platinum.demand_series(silver_hourly(spark, sf_dir))
