"""Views behind the demand-intelligence page, over the demand series.

The reference computes these for one selected zone in a pandas frame. Here
each view is computed for every zone at once (grouping by zone), so a page
is a filter on a precomputed result. The series has one row per zone and
hour, so every group is bounded by the time span, not by the trip volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.functions.columns import (
    DAY_TYPE,
    DOW_ORDER,
    dow_monday0,
    dow_name,
    map_values,
    month_label,
    month_name,
    month_number_name,
)
from tripflow.operators.platinum import ZONE, series_ts

# Seasonality band edges (share of the zone's monthly mean).
PEAK_RATIO = 1.1
TROUGH_RATIO = 0.9


def enrich_series(series: DataFrame, dim: DataFrame) -> DataFrame:
    """Add zone and borough names to the series."""
    names = dim.select(F.col("location_id").alias(ZONE), "zone", "borough")
    return series.join(names, on=ZONE, how="left")


def with_series_ts(df: DataFrame, name: str = "datetime") -> DataFrame:
    """The hour's timestamp from trip_date + pickup_hour."""
    return df.withColumn(name, series_ts())


def filter_zone(df: DataFrame, zone_id, col: str = ZONE) -> DataFrame:
    """One zone's rows. ``zone_id`` may be a literal or a Column (for
    example a scalar subquery)."""
    return df.filter(F.col(col) == zone_id)


def default_zone(df: DataFrame, col: str = ZONE):
    """The selector's default: the first zone id in sorted order, as a
    scalar subquery."""
    return df.select(F.min(col)).scalar()


def distinct_sorted(df: DataFrame, cols) -> DataFrame:
    """Distinct values of ``cols``, sorted (NULLs dropped)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    out = df.select(*cols).dropna().distinct()
    return out.orderBy(*cols)


def calendar_labels(series: DataFrame) -> DataFrame:
    """Label columns for a series: day type, weekday and month names."""
    return series.withColumns(
        {
            "day_type": map_values("is_weekend", DAY_TYPE),
            "dow_name": dow_name("trip_date"),
            "month_name": month_name("trip_date"),
            "month_label": month_label("trip_date"),
        }
    )


def hour_profile(series: DataFrame) -> DataFrame:
    """Mean trips by zone x hour x weekday/weekend, with the peak hour of
    each zone and day type flagged (earliest hour on ties)."""
    prof = series.groupBy(ZONE, "pickup_hour", "is_weekend").agg(
        F.avg("trip_count").alias("avg_trips")
    )
    rank = F.row_number().over(
        Window.partitionBy(ZONE, "is_weekend").orderBy(
            F.col("avg_trips").desc(), F.col("pickup_hour")
        )
    )
    return prof.withColumns(
        {
            "day_type": map_values("is_weekend", DAY_TYPE),
            "is_peak": F.when(rank == 1, 1).otherwise(0),
        }
    )


def typical_week(series: DataFrame) -> DataFrame:
    """Mean trips by zone x weekday (Monday = 0) x hour."""
    return series.groupBy(
        F.col(ZONE),
        dow_monday0("trip_date").alias("dow_num"),
        dow_name("trip_date").alias("dow_name"),
        F.col("pickup_hour"),
    ).agg(F.avg("trip_count").alias("avg_trips"))


def week_extremes(series: DataFrame) -> DataFrame:
    """K4 on A27: busiest and quietest weekday-hour slot per zone (earliest
    slot on ties)."""
    tw = typical_week(series)
    slot = F.struct("dow_num", "dow_name", "pickup_hour", "avg_trips")
    busiest = F.min_by(slot, F.struct(-F.col("avg_trips"), "dow_num", "pickup_hour"))
    quietest = F.min_by(slot, F.struct(F.col("avg_trips"), "dow_num", "pickup_hour"))
    return tw.groupBy(ZONE).agg(busiest.alias("b"), quietest.alias("q")).select(
        ZONE,
        F.col("b.dow_name").alias("busiest_dow"),
        F.col("b.pickup_hour").alias("busiest_hour"),
        F.col("b.avg_trips").alias("busiest_avg_trips"),
        F.col("q.dow_name").alias("quietest_dow"),
        F.col("q.pickup_hour").alias("quietest_hour"),
        F.col("q.avg_trips").alias("quietest_avg_trips"),
    )


def season_band(monthly: DataFrame, value: str = "avg_trips") -> DataFrame:
    """Peak if >= 110 % of the zone's mean over months, trough if
    <= 90 %, else normal."""
    mean = F.avg(value).over(Window.partitionBy(ZONE))
    band = (
        F.when(F.col(value) >= mean * PEAK_RATIO, "peak")
        .when(F.col(value) <= mean * TROUGH_RATIO, "trough")
        .otherwise("normal")
    )
    return monthly.withColumn("season_band", band)


def monthly_seasonality(series: DataFrame) -> DataFrame:
    """A28 (rows): mean trips per zone and calendar month, banded."""
    m = series.groupBy(ZONE, "month").agg(F.avg("trip_count").alias("avg_trips"))
    return season_band(m.withColumn("month_name", month_number_name("month")))


def seasonality_summary(series: DataFrame) -> DataFrame:
    """A28 (figures): peak and trough month per zone and the swing in
    percent (earliest month on ties; NULL swing when the trough is 0)."""
    m = monthly_seasonality(series)
    slot = F.struct("month", "month_name", "avg_trips")
    peak = F.min_by(slot, F.struct(-F.col("avg_trips"), "month"))
    trough = F.min_by(slot, F.struct(F.col("avg_trips"), "month"))
    return (
        m.groupBy(ZONE)
        .agg(peak.alias("p"), trough.alias("t"))
        .select(
            ZONE,
            F.col("p.month_name").alias("peak_month"),
            F.col("p.avg_trips").alias("peak_avg_trips"),
            F.col("t.month_name").alias("trough_month"),
            F.col("t.avg_trips").alias("trough_avg_trips"),
            ((F.try_divide(F.col("p.avg_trips"), F.col("t.avg_trips")) - 1) * 100).alias(
                "swing_pct"
            ),
        )
    )


def borough_demand(enriched: DataFrame) -> DataFrame:
    """Mean hourly trips per borough, descending."""
    return (
        enriched.filter(F.col("borough").isNotNull())
        .groupBy("borough")
        .agg(F.avg("trip_count").alias("avg_hourly"))
        .orderBy(F.col("avg_hourly").desc(), "borough")
    )


def zone_kpis(series: DataFrame) -> DataFrame:
    """Mean trips, interpolated P95, mean fare and distance per zone
    (zero-filled hours included)."""
    return series.groupBy(ZONE).agg(
        F.avg("trip_count").alias("avg_demand"),
        F.percentile(F.col("trip_count"), F.lit(0.95)).alias("p95_demand"),
        F.avg("avg_fare").alias("avg_fare"),
        F.avg("avg_distance").alias("avg_distance"),
    )


def yoy_monthly(series: DataFrame) -> DataFrame:
    """Mean trips per zone, year and month."""
    return series.groupBy(
        F.col(ZONE),
        F.year("trip_date").alias("year"),
        F.month("trip_date").alias("month_num"),
        month_name("trip_date").alias("month_name"),
    ).agg(F.avg("trip_count").alias("avg_trips"))


def demand_heatmap(series: DataFrame) -> DataFrame:
    """Hour x Mon..Sun matrix of mean trips per zone. The pivot values
    are fixed, so no pass over the data is needed to find them."""
    return (
        series.withColumn("dow_name", dow_name("trip_date"))
        .groupBy(ZONE, "pickup_hour")
        .pivot("dow_name", list(DOW_ORDER))
        .agg(F.avg("trip_count"))
    )


def recent_monthly(series: DataFrame, n: int = 6) -> DataFrame:
    """Mean trips per zone and month for each zone's last ``n`` months."""
    m = series.groupBy(
        F.col(ZONE), F.trunc("trip_date", "month").alias("month_start")
    ).agg(F.avg("trip_count").alias("avg_trips"))
    rn = F.row_number().over(Window.partitionBy(ZONE).orderBy(F.col("month_start").desc()))
    return m.withColumn("_rn", rn).filter(F.col("_rn") <= n).drop("_rn")


def data_through(series: DataFrame) -> DataFrame:
    """Last hour in the series and its ``Month YYYY`` label."""
    last = F.max(series_ts())
    return series.agg(last.alias("data_through")).withColumn(
        "data_through_label", F.date_format("data_through", "MMMM yyyy")
    )


def demand_hotspots(enriched: DataFrame, k: int = 20) -> DataFrame:
    """K3: top zones by mean hourly trips (zone id breaks ties)."""
    return (
        enriched.filter(F.col("zone").isNotNull() & F.col("borough").isNotNull())
        .groupBy(ZONE, "zone", "borough")
        .agg(F.avg("trip_count").alias("avg_hourly_demand"))
        .orderBy(F.col("avg_hourly_demand").desc(), ZONE)
        .limit(k)
    )
