"""Views behind the historical BI page, over the Gold facts.

The facts are small (one row per year x key), so these are cheap; they stay
DataFrames end to end and only the final view leaves the executors.

pandas semantics kept on purpose:
* grouping drops NULL keys, so a fact row whose code has no dimension row is
  excluded after the left join, and shares are over the non-NULL total;
* dashboard averages are unweighted means of yearly means (``*_weighted``
  variants give the trip-weighted figure).
Top-k views break ties on the key columns so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.functions.columns import capitalize, with_share
from tripflow.operators.gold import DISTANCE_ORDER


def filter_years(df: DataFrame, years, col: str = "trip_year") -> DataFrame:
    """Keep the selected years; frames without the column pass through."""
    if col not in df.columns or years is None:
        return df
    return df.filter(F.col(col).isin(list(years)))


def enrich_payment(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """J1. The dimension is a fixed data-dictionary table, so it is
    broadcast."""
    return fact.join(F.broadcast(dim), on="payment_type", how="left")


def enrich_vendor(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """J2 (fixed dictionary table, broadcast)."""
    return fact.join(F.broadcast(dim), on="vendor_id", how="left")


def enrich_rate_code(trips: DataFrame, dim: DataFrame) -> DataFrame:
    """S5's rate names beside Silver's rate codes (fixed dictionary table of seven
    rows, broadcast)."""
    return trips.join(F.broadcast(dim.withColumnRenamed("rate_code_id", "ratecode_id")), on="ratecode_id", how="left")


def enrich_store_flag(trips: DataFrame, dim: DataFrame) -> DataFrame:
    """S5's descriptions of the store-and-forward flag (two rows, broadcast)."""
    return trips.join(F.broadcast(dim), on="store_and_fwd_flag", how="left")


def rate_summary(trips: DataFrame, rates: DataFrame, flags: DataFrame) -> DataFrame:
    """Trips, revenue and mean fare of each year by rate and by how the record
    was sent. Grouped by code first, so that the dictionaries meet a few rows."""
    keys = ("trip_year", "ratecode_id", "store_and_fwd_flag")
    totals = trips.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_trips"), F.sum("total_amount").alias("total_revenue"), F.avg("fare_amount").alias("avg_fare")
    )
    return enrich_store_flag(enrich_rate_code(totals, rates), flags).select(
        "trip_year", "ratecode_id", "rate_name", "store_flag_desc", "total_trips", "total_revenue", "avg_fare"
    )


def enrich_location(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """The zone lookup joins on differently named keys. No hint: the
    lookup is a file whose size the planner knows, so it broadcasts it when
    under the threshold and shuffles otherwise."""
    return fact.join(dim, fact["pu_location_id"] == dim["location_id"], "left").drop(
        dim["location_id"]
    )


def kpis(fact_year: DataFrame) -> DataFrame:
    """Headline figures; averages are means of the yearly means."""
    return fact_year.agg(
        F.sum("total_trips").alias("total_trips"),
        F.sum("total_revenue").alias("total_revenue"),
        F.avg("avg_trip_value").alias("avg_trip_value"),
        F.avg("avg_distance").alias("avg_distance"),
        F.avg("avg_fare_per_mile").alias("avg_fare_per_mile"),
    )


def kpis_weighted(fact_year: DataFrame) -> DataFrame:
    """Trip-weighted variant of A19's averages."""
    w = F.col("total_trips")
    return fact_year.agg(
        F.sum(w).alias("total_trips"),
        F.sum("total_revenue").alias("total_revenue"),
        F.try_divide(F.sum("total_revenue"), F.sum(w)).alias("avg_trip_value"),
        F.try_divide(F.sum(F.col("avg_distance") * w), F.sum(w)).alias("avg_distance"),
        F.try_divide(F.sum(F.col("avg_fare_per_mile") * w), F.sum(w)).alias(
            "avg_fare_per_mile"
        ),
    )


def yearly_trend(fact_year: DataFrame) -> DataFrame:
    """K6: the yearly fact in year order."""
    return fact_year.orderBy("trip_year")


def yoy_change(fact_year: DataFrame) -> DataFrame:
    """Percent change in revenue and trips against the previous year.

    The input has one row per year, so the unpartitioned window holds a
    handful of rows."""
    w = Window.orderBy("trip_year")

    def pct(c):
        return (F.try_divide(F.col(c), F.lag(c, 1).over(w)) - 1) * 100

    return fact_year.select(
        "trip_year",
        "total_revenue",
        "total_trips",
        pct("total_revenue").alias("revenue_change_pct"),
        pct("total_trips").alias("trips_change_pct"),
    )


def payment_mix(fact_payment: DataFrame) -> DataFrame:
    """A20 + W6: trips by payment name, share of the named total, and a rank
    (1 = top payment type)."""
    mix = (
        fact_payment.filter(F.col("payment_name").isNotNull())
        .groupBy("payment_name")
        .agg(F.sum("total_trips").alias("total_trips"))
    )
    # One row per payment name (bounded by the payment dictionary), so the
    # ranking window is tiny.
    rank = F.row_number().over(
        Window.orderBy(F.col("total_trips").desc(), F.col("payment_name"))
    )
    return with_share(mix, "total_trips", "trip_share").withColumn("rank", rank)


def payment_value(fact_payment: DataFrame) -> DataFrame:
    """Mean of the yearly average trip values per payment name."""
    return (
        fact_payment.filter(F.col("payment_name").isNotNull())
        .groupBy("payment_name")
        .agg(F.avg("avg_trip_value").alias("avg_trip_value"))
    )


def payment_value_weighted(fact_payment: DataFrame) -> DataFrame:
    """Trip-weighted variant of A21: revenue over trips per payment name."""
    return (
        fact_payment.filter(F.col("payment_name").isNotNull())
        .groupBy("payment_name")
        .agg(F.try_divide(F.sum("total_revenue"), F.sum("total_trips")).alias("avg_trip_value"))
    )


def vendor_summary(fact_vendor: DataFrame) -> DataFrame:
    """By vendor name, revenue descending."""
    return (
        fact_vendor.filter(F.col("vendor_name").isNotNull())
        .groupBy("vendor_name")
        .agg(
            F.sum("total_trips").alias("total_trips"),
            F.sum("total_revenue").alias("total_revenue"),
            F.avg("avg_fare_per_mile").alias("avg_fare_per_mile"),
            F.avg("avg_passengers").alias("avg_passengers"),
        )
        .orderBy(F.col("total_revenue").desc(), "vendor_name")
    )


def _bucket_order():
    return F.array_position(F.array(*[F.lit(b) for b in DISTANCE_ORDER]), F.col("distance_bucket")).cast("int") - 1


def distance_summary(fact_distance: DataFrame) -> DataFrame:
    """Volume, mean trip value and mean fare per mile per bucket, in
    short/medium/long order."""
    return (
        fact_distance.groupBy("distance_bucket")
        .agg(
            F.sum("total_trips").alias("total_trips"),
            F.avg("avg_trip_value").alias("avg_trip_value"),
            F.avg("avg_fare_per_mile").alias("avg_fpm"),
        )
        .withColumn("bucket_order", _bucket_order())
        .orderBy("bucket_order")
    )


def distance_highlights(fact_distance: DataFrame) -> DataFrame:
    """K4 on A23: bucket with most trips and bucket with the highest mean
    fare per mile, capitalised (one row)."""
    s = distance_summary(fact_distance)
    return s.agg(
        capitalize(F.max_by("distance_bucket", F.struct(F.col("total_trips"), -F.col("bucket_order")))).alias("top_volume_bucket"),
        capitalize(F.max_by("distance_bucket", F.struct(F.col("avg_fpm"), -F.col("bucket_order")))).alias("top_fpm_bucket"),
    )


def hourly_trips(fact_time: DataFrame) -> DataFrame:
    """Trips per pickup hour."""
    return fact_time.groupBy("pickup_hour").agg(F.sum("total_trips").alias("total_trips"))


def peak_hour(fact_time: DataFrame) -> DataFrame:
    """K4 on A24: the busiest hour (earliest on ties)."""
    return (
        hourly_trips(fact_time)
        .orderBy(F.col("total_trips").desc(), F.col("pickup_hour"))
        .limit(1)
    )


def borough_trips(fact_location: DataFrame) -> DataFrame:
    """A25 + W6: trips per borough, share of the named total, and rank, most
    trips first (one row a borough, so the window is small)."""
    b = (
        fact_location.filter(F.col("borough").isNotNull())
        .groupBy("borough")
        .agg(F.sum("total_trips").alias("total_trips"))
    )
    rank = F.row_number().over(Window.orderBy(F.col("total_trips").desc(), "borough"))
    shares = with_share(b, "total_trips", "trip_share")
    return shares.withColumn("borough_rank", rank).orderBy("borough_rank")


def top_zones_by_revenue(fact_location: DataFrame, k: int = 10) -> DataFrame:
    """K1: top zones by revenue (ids sharing zone and borough merge)."""
    return (
        fact_location.filter(F.col("zone").isNotNull() & F.col("borough").isNotNull())
        .groupBy("zone", "borough")
        .agg(
            F.sum("total_revenue").alias("total_revenue"),
            F.sum("total_trips").alias("total_trips"),
        )
        .orderBy(F.col("total_revenue").desc(), "zone", "borough")
        .limit(k)
    )


def premium_zones(fact_location: DataFrame, k: int = 10) -> DataFrame:
    """K2: top zones by the mean of their yearly average trip value."""
    return (
        fact_location.filter(F.col("zone").isNotNull())
        .groupBy("zone")
        .agg(F.avg("avg_trip_value").alias("avg_trip_value"))
        .orderBy(F.col("avg_trip_value").desc(), "zone")
        .limit(k)
    )
