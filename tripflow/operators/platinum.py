"""Platinum: the dense zone x hour demand series with calendar and lag features.

Plan shape (one scan of Silver):

* ``hourly_demand`` aggregates trips to (zone, date, hour) with partial
  aggregation map-side, so a hot zone costs one row per map task and hour.
  Everything after it works on at most zones x hours rows, whatever the trip
  volume.
* Zone totals, the percentile threshold and the hour bounds are derived from
  that aggregate; the threshold and bounds are scalar subqueries, computed
  once on the cluster and never collected by user code.
* The grid is generated per zone with ``explode(sequence(start, end, 1h))``,
  not with a cross join; the densifying left join then drops non-selected
  zones, so the trip volume is never semi-joined against a zone list.
* Lags are row lags per zone on the dense grid; each window partition is one
  zone's hours, bounded by the time span, never by the trip count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.session import checkpoint_root

ZONE = "pu_location_id"
SERIES_KEYS = (ZONE, "trip_date", "pickup_hour")

# Feature-store parameters.
TOP_ZONE_PERCENTILE = 0.6
LAGS = (1, 24, 168)
RUSH_HOURS = ((7, 10), (16, 19))
NIGHT_HOURS = ((22, 23), (0, 5))
WEEKEND_DAYS = (1, 7)  # Spark dayofweek: 1 = Sunday, 7 = Saturday
FILL_VALUES = {"trip_count": 0, "avg_fare": 0.0, "avg_distance": 0.0, "avg_passengers": 0.0}


def one_hour() -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(1))


def hourly_demand(trips: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    """Trips, mean fare, distance and passengers per zone and pickup
    hour. The date is recomputed from the pickup (Silver's ``trip_date`` is
    the dropoff date)."""
    return trips.groupBy(
        F.col(ZONE), F.to_date(ts).alias("trip_date"), F.col("pickup_hour")
    ).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("passenger_count").alias("avg_passengers"),
    )


def zone_totals(df: DataFrame, count_col: str | None = None) -> DataFrame:
    """Trips per zone. Counts rows, or sums ``count_col`` when given an
    already aggregated frame. NULL zones are excluded (they cannot be ranked
    or keyed)."""
    total = F.count(F.lit(1)) if count_col is None else F.sum(count_col)
    return df.filter(F.col(ZONE).isNotNull()).groupBy(ZONE).agg(
        total.alias("total_trips")
    )


def zone_threshold(totals: DataFrame, p: float = TOP_ZONE_PERCENTILE) -> DataFrame:
    """Exact interpolated percentile of the zone totals, one row."""
    return totals.select(F.percentile(F.col("total_trips"), F.lit(p)).alias("threshold"))


def select_top_zones(totals: DataFrame, p: float = TOP_ZONE_PERCENTILE) -> DataFrame:
    threshold = zone_threshold(totals, p).scalar()
    return totals.filter(F.col("total_trips") >= threshold)


def top_zones(trips: DataFrame, p: float = TOP_ZONE_PERCENTILE) -> DataFrame:
    """Zones whose trip total reaches the p-th percentile."""
    return select_top_zones(zone_totals(trips), p)


def hour_bounds(trips: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    """First and last pickup, truncated to the hour (one row)."""
    return trips.select(
        F.date_trunc("hour", F.min(ts)).alias("start"),
        F.date_trunc("hour", F.max(ts)).alias("end"),
    )


def hourly_bounds(hourly: DataFrame) -> DataFrame:
    """A14 from an hourly aggregate: the same bounds, read off the
    (date, hour) keys instead of rescanning trips."""
    hour_ts = series_ts()
    return hourly.select(F.min(hour_ts).alias("start"), F.max(hour_ts).alias("end"))


def hour_sequence(bounds: DataFrame) -> DataFrame:
    """One row per hour from start to end inclusive."""
    return bounds.select(
        F.explode(F.sequence("start", "end", one_hour())).alias("timestamp_hour")
    )


def hour_zone_grid(zones: DataFrame, bounds: DataFrame) -> DataFrame:
    """Every selected zone x every hour in the bounds.

    Each zone row expands its own hour sequence; the bounds enter as scalar
    subqueries, so there is no cross join and the work spreads over zones.
    """
    start = bounds.select("start").scalar()
    end = bounds.select("end").scalar()
    return zones.select(
        F.col(ZONE), F.explode(F.sequence(start, end, one_hour())).alias("timestamp_hour")
    ).withColumns(
        {
            "trip_date": F.to_date("timestamp_hour"),
            "pickup_hour": F.hour("timestamp_hour"),
        }
    )


def semi_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips in the selected zones, as a semi join (no list on the
    driver). The planner broadcasts the zone side when its statistics, or
    AQE's runtime size, are under the broadcast threshold."""
    return trips.join(zones.select(ZONE), on=ZONE, how="left_semi")


def fill_missing_hours(df: DataFrame) -> DataFrame:
    """P20: hours without trips get zero counts and zero averages."""
    return df.fillna(FILL_VALUES)


def densify(grid: DataFrame, actual: DataFrame) -> DataFrame:
    """Left join the observed hours onto the grid, then P20."""
    return fill_missing_hours(grid.join(actual, on=list(SERIES_KEYS), how="left"))


def _in_ranges(c: Column, ranges) -> Column:
    cond = None
    for lo, hi in ranges:
        part = c.between(lo, hi)
        cond = part if cond is None else cond | part
    return cond


def add_series_calendar(df: DataFrame) -> DataFrame:
    """Weekday, month, year of ``trip_date`` and weekend, rush-hour and
    night flags (all ranges inclusive)."""
    hour = F.col("pickup_hour")
    df = df.withColumns(
        {
            "day_of_week": F.dayofweek("trip_date"),
            "month": F.month("trip_date"),
            "trip_year": F.year("trip_date"),
        }
    )
    return df.withColumns(
        {
            "is_weekend": F.when(F.col("day_of_week").isin(*WEEKEND_DAYS), 1).otherwise(0),
            "is_rush_hour": F.when(_in_ranges(hour, RUSH_HOURS), 1).otherwise(0),
            "is_night": F.when(_in_ranges(hour, NIGHT_HOURS), 1).otherwise(0),
        }
    )


def series_window() -> Window:
    return Window.partitionBy(ZONE).orderBy("trip_date", "pickup_hour")


def add_lags(series: DataFrame, lags=LAGS, col: str = "trip_count") -> DataFrame:
    """Row lags per zone; on the dense grid a row lag is an hour lag."""
    w = series_window()
    return series.withColumns({f"lag_{n}h": F.lag(col, n).over(w) for n in lags})


def add_rolling_mean(series: DataFrame, n: int = 24, col: str = "trip_count") -> DataFrame:
    """Mean of the previous ``n`` hours (current hour excluded)."""
    w = series_window().rowsBetween(-n, -1)
    return series.withColumn(f"rolling_mean_{n}h", F.avg(col).over(w))


def series_ts(date_col: str = "trip_date", hour_col: str = "pickup_hour") -> Column:
    """The hour's timestamp from its date and hour."""
    return F.col(date_col).cast("timestamp") + F.make_dt_interval(
        F.lit(0), F.col(hour_col)
    )


def demand_series(
    trips: DataFrame,
    p: float = TOP_ZONE_PERCENTILE,
    lags=LAGS,
    materialize: bool = True,
    since=None,
) -> DataFrame:
    """Silver trips -> the Platinum feature table.

    The hourly aggregate feeds five consumers (zone totals, the percentile
    threshold, both hour bounds, the densifying join). With ``materialize``
    it is checkpointed once into ``spark.checkpoint.dir`` (reliable,
    shared storage), so Silver is scanned exactly once and a lost executor
    recomputes from the checkpoint, not from the trips. The checkpoint holds
    zones x hours rows, never trip rows.

    ``since`` (off by default) drops pickups before that time: the grid spans
    first to last pickup, so one stray ancient pickup would otherwise add
    years x zones empty rows.
    """
    if since is not None:
        trips = trips.filter(F.col("pickup_datetime") >= F.lit(since).cast("timestamp"))
    hourly, grid = hourly_and_grid(trips, p, materialize)
    return add_lags(add_series_calendar(densify(grid, hourly)), lags)


def hourly_and_grid(trips: DataFrame, p: float = TOP_ZONE_PERCENTILE, materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    """A16 and J5 from one scan of the trips."""
    hourly = hourly_demand(trips)
    if materialize:
        checkpoint_root(trips.sparkSession)
        hourly = hourly.checkpoint(eager=True)
    zones = select_top_zones(zone_totals(hourly, count_col="trip_count"), p)
    return hourly, hour_zone_grid(zones.select(ZONE), hourly_bounds(hourly))


def order_series(series: DataFrame) -> DataFrame:
    """K5: zone-clustered, time-ordered within each partition. A global sort
    is left to the final output, if one is wanted at all."""
    return series.repartition(ZONE).sortWithinPartitions(ZONE, "trip_date", "pickup_hour")


# ------------------------------------------------------------ additive state
HOURLY_MEANS = {"avg_fare": "fare_amount", "avg_distance": "trip_distance", "avg_passengers": "passenger_count"}


def hourly_state(trips: DataFrame, load: str = "load_id", ts: str = "pickup_datetime") -> DataFrame:
    """A16 of each load as sums and counts, which add up over loads."""
    sums = [f(c).alias(f"{n}_{c}") for c in HOURLY_MEANS.values() for n, f in (("sum", F.sum), ("n", F.count))]
    return trips.groupBy(load, ZONE, F.to_date(ts).alias("trip_date"), "pickup_hour").agg(F.count(F.lit(1)).alias("trip_count"), *sums)


def merge_hourly(state: DataFrame) -> DataFrame:
    """``hourly_demand`` of all trips, from the states of their loads."""
    names = [f"{n}_{c}" for c in HOURLY_MEANS.values() for n in ("sum", "n")]
    added = state.groupBy(*SERIES_KEYS).agg(*[F.sum(c).alias(c) for c in ("trip_count", *names)])
    return added.select(*SERIES_KEYS, "trip_count", *[F.try_divide(F.col(f"sum_{c}"), F.col(f"n_{c}")).alias(name) for name, c in HOURLY_MEANS.items()])


def series_of(hourly: DataFrame, p: float = TOP_ZONE_PERCENTILE, lags=LAGS, since=None) -> DataFrame:
    """The feature table from an hourly aggregate. ``since`` (a timestamp column):
    only the hours from then on, computed from as many hours before as the longest
    lag reaches back."""
    zones = select_top_zones(zone_totals(hourly, count_col="trip_count"), p).select(ZONE)
    bounds, actual = hourly_bounds(hourly), hourly
    if since is not None:
        first = since - F.make_dt_interval(F.lit(0), F.lit(max(lags)))
        bounds = bounds.select(F.greatest("start", first).alias("start"), "end")
        actual = hourly.where(series_ts() >= first)
    series = add_lags(add_series_calendar(densify(hour_zone_grid(zones, bounds), actual)), lags)
    return series if since is None else series.where(series_ts() >= since)
