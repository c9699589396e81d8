"""90-day recursive forecast and its roll-ups.

Step t of the forecast needs the prediction of step t-1 (it feeds the lag
features), so the horizon is sequential, but zones are independent. Zones are
dealt to tasks; a task holds its zones' hours as the rows of one array, seed
hours first, and advances all of them one hour at a time. The saved trees are read
once (bounded by trees x leaves) and broadcast, like the calendar of the horizon.

A group holds ``ZONES_PER_TASK`` zones' seeds (at most ``seed_rows`` hours each)
and emits ``hours`` rows for each, so its size is bounded by parameters, not by
data volume.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.functions.columns import month_label
from tripflow.operators.boosting import Ensemble
from tripflow.operators.model import ZONE_INDEX, load_model
from tripflow.operators.platinum import LAGS, ZONE, add_series_calendar, one_hour, series_ts
from tripflow.session import ship_package

# Forecast and capacity-planning parameters.
HORIZON_HOURS = 90 * 24
SEED_ROWS = 500
SEED_AVG_ROWS = 24
PEAK_FACTOR = 1.5
DEFAULT_TRIPS_PER_DRIVER_HOUR = 2.0
#: Zones whose hours one task advances together.
ZONES_PER_TASK = 16
AVG_COLS = ("avg_fare", "avg_distance", "avg_passengers")


def seed_rows(series: DataFrame, n: int = SEED_ROWS) -> DataFrame:
    """Each zone's last ``n`` hours."""
    w = Window.partitionBy(ZONE).orderBy(F.col("trip_date").desc(), F.col("pickup_hour").desc())
    return series.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def seed_averages(series: DataFrame, n: int = SEED_AVG_ROWS) -> DataFrame:
    """Mean fare, distance and passengers over each zone's last ``n``
    observed hours; they stay constant over the horizon."""
    return seed_rows(series, n).groupBy(ZONE).agg(*[F.avg(c).alias(c) for c in AVG_COLS])


def forecast_start(series: DataFrame):
    """The hour after the global last hour (scalar subquery)."""
    return series.select(F.max(series_ts())).scalar() + one_hour()


def future_grid(zones: DataFrame, start, hours: int = HORIZON_HOURS) -> DataFrame:
    """M9: every zone x the next ``hours`` hours, with P19's calendar."""
    end = start + F.make_dt_interval(F.lit(0), F.lit(hours - 1))
    grid = zones.select(
        F.col(ZONE), F.explode(F.sequence(start, end, one_hour())).alias("datetime")
    ).withColumns({"trip_date": F.to_date("datetime"), "pickup_hour": F.hour("datetime")})
    return add_series_calendar(grid)


def horizon_calendar(spark: SparkSession, start, hours: int) -> pd.DataFrame:
    """P19's calendar of the forecast hours (one row an hour, ``hours`` rows)."""
    one = spark.range(1).select(F.col("id").alias(ZONE))
    return future_grid(one, start, hours).orderBy("datetime").drop(ZONE).toPandas()


def make_forecaster(trees: Ensemble, features: list, zone_labels: list, calendar: pd.DataFrame):
    """The function over one task's zones run by ``applyInPandas``.

    M8: a lag that the array doesn't hold, or holds as missing, is the last
    hour's value, and 0 where that is missing too."""
    number = {label: i for i, label in enumerate(zone_labels)}
    column = {ZONE_INDEX if c == ZONE else c: k for k, c in enumerate(features)}
    hours = len(calendar)
    fixed = {c: calendar[c].to_numpy(dtype=float) for c in calendar.columns if c in column}

    def run(seeds: pd.DataFrame) -> pd.DataFrame:
        seeds = seeds.sort_values([ZONE, "trip_date", "pickup_hour"])
        zones, row = np.unique(seeds[ZONE].to_numpy(), return_inverse=True)
        counts = np.bincount(row)
        width = int(counts.max())
        place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + (width - counts)[row]
        series = np.full((len(zones), width + hours), np.nan)
        series[row, place] = seeds["trip_count"].to_numpy(dtype=float)
        recent = seeds[place >= width - SEED_AVG_ROWS]
        means = recent.groupby(ZONE)[list(AVG_COLS)].mean().reindex(zones)

        x = np.zeros((len(zones), len(column)))
        x[:, column[ZONE_INDEX]] = [number.get(str(z), len(number)) for z in zones]
        for c in AVG_COLS:
            # Same-hour and previous-hour averages both hold the seed means
            # over the whole horizon (predicted hours carry no averages).
            for name in (c, f"{c}_lag_1h"):
                if name in column:
                    x[:, column[name]] = means[c]
        lags = np.zeros((len(LAGS), len(zones), hours))
        missing = np.full(len(zones), np.nan)
        for t in range(hours):
            now = width + t
            other = np.zeros(len(zones))
            for k, back in enumerate(LAGS):
                held = series[:, now - back] if back <= now else missing
                lags[k, :, t] = np.where(np.isnan(held), other, held)
                other = lags[0, :, t]
                if f"lag_{back}h" in column:
                    x[:, column[f"lag_{back}h"]] = lags[k, :, t]
            for c, values in fixed.items():
                x[:, column[c]] = values[t]
            series[:, now] = np.maximum(trees.predict(x), 0.0)
        out = {ZONE: np.repeat(zones, hours), "datetime": np.tile(calendar["datetime"].to_numpy(), len(zones)), "trip_count": series[:, width:].ravel()}
        out |= {f"lag_{n}h": lags[k].ravel() for k, n in enumerate(LAGS)}
        return pd.DataFrame(out | {c: np.repeat(means[c].to_numpy(), hours) for c in AVG_COLS})

    return run


FORECAST_SCHEMA = (
    f"{ZONE} BIGINT, datetime TIMESTAMP, trip_count DOUBLE, "
    + ", ".join(f"lag_{n}h DOUBLE" for n in LAGS) + ", " + ", ".join(f"{c} DOUBLE" for c in AVG_COLS)
)


def forecast(
    model: Ensemble,
    model_path: str | None,
    series: DataFrame,
    hours: int = HORIZON_HOURS,
    seed: int = SEED_ROWS,
) -> DataFrame:
    """M7: recursive hourly forecast for every zone, with the lags and means
    each hour was predicted from.

    The driver reads the saved trees (``model_path``; ``model`` where it is None),
    the number of zones and the calendar of the horizon (``hours`` rows).
    """
    spark = series.sparkSession
    trees = load_model(model_path) if model_path else model
    calendar = horizon_calendar(spark, forecast_start(series), hours)
    fn = make_forecaster(trees, trees.features, trees.labels, calendar)
    tasks = max(1, -(-series.select(ZONE).distinct().count() // ZONES_PER_TASK))
    seeds = seed_rows(series, seed).select(
        ZONE, "trip_date", "pickup_hour", "trip_count", *AVG_COLS,
        F.pmod(F.xxhash64(ZONE), F.lit(tasks)).alias("_task"),
    )
    ship_package(spark)
    # The seeds are tiny but a group is thousands of steps: a shuffle sized by
    # data would be merged into a task or two, so the number is given.
    return seeds.repartition(tasks, "_task").groupBy("_task").applyInPandas(
        lambda rows: fn(rows.drop(columns="_task")), FORECAST_SCHEMA
    )


def with_features(fc: DataFrame) -> DataFrame:
    """The forecast's hours with every feature of the model: P19's calendar
    beside the lags and means that the forecast carries."""
    hours = fc.withColumns({"trip_date": F.to_date("datetime"), "pickup_hour": F.hour("datetime")})
    return add_series_calendar(hours).withColumns({f"{c}_lag_1h": F.col(c) for c in AVG_COLS})


def weekly_projection(fc: DataFrame, ts: str = "datetime") -> DataFrame:
    """Mean forecast per zone and week (weeks start on Monday)."""
    return fc.groupBy(
        F.col(ZONE), F.to_date(F.date_trunc("week", F.col(ts))).alias("week_start")
    ).agg(F.avg("trip_count").alias("avg_trips"))


def monthly_projection(fc: DataFrame, ts: str = "datetime") -> DataFrame:
    return fc.groupBy(
        F.col(ZONE), F.to_date(F.date_trunc("month", F.col(ts))).alias("month_start")
    ).agg(F.avg("trip_count").alias("avg_hourly_demand"))


def driver_requirement(
    fc: DataFrame, rate: float = DEFAULT_TRIPS_PER_DRIVER_HOUR, ts: str = "datetime"
) -> DataFrame:
    """Drivers needed per zone and month: mean demand / trips per
    driver-hour, and 1.5x that for the peak, both rounded half to even."""
    if not 1.0 <= rate <= 4.0:
        raise ValueError("trips per driver-hour must be within 1-4")
    m = monthly_projection(fc, ts)
    return m.withColumns(
        {
            "avg_drivers": F.bround(F.col("avg_hourly_demand") / rate, 0).cast("int"),
            "peak_drivers": F.bround(F.col("avg_hourly_demand") * PEAK_FACTOR / rate, 0).cast("int"),
            "month_label": month_label("month_start"),
        }
    )


def driver_summary(req: DataFrame) -> DataFrame:
    """A35 figures: truncated mean of monthly drivers and the peak maximum,
    per zone."""
    return req.groupBy(ZONE).agg(
        F.floor(F.avg("avg_drivers")).cast("int").alias("avg_drivers"),
        F.max("peak_drivers").alias("max_peak_drivers"),
    )
