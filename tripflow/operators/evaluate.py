"""Hold-out split, baseline, error metrics and evaluation views.

Metrics are plain aggregates (global or grouped by zone), so the per-zone
Python loop of a single-machine version becomes one grouped aggregation.
R^2 uses ``var_pop`` (a numerically stable one-pass central moment) for the
total sum of squares, so nothing needs a second pass over the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.columns import clip_nonneg
from tripflow.operators.platinum import ZONE, series_ts

LAG_COLS = ("lag_1h", "lag_24h", "lag_168h")

# Demand buckets (upper edges inclusive; first bucket includes
# 0) and their labels, in order.
DEMAND_BUCKETS = (
    (10, "very low (<10)"),
    (50, "low (10–50)"),
    (200, "medium (50–200)"),
    (None, "high (200+)"),
)
# Rounding of the per-zone metrics (half to even).
ZONE_METRIC_PLACES = {"mae": 2, "rmse": 2, "r2": 4, "mape": 2}


def drop_warmup(df: DataFrame, lags=LAG_COLS) -> DataFrame:
    """Drop the first hours of each zone, where a lag is NULL."""
    return df.dropna(subset=list(lags))


def time_split(series: DataFrame, days: int = 30) -> tuple[DataFrame, DataFrame]:
    """M1: cutoff = last hour - ``days``; train <= cutoff < test; warm-up
    rows dropped on both sides. The last hour is a scalar subquery."""
    ts = series_ts()
    last = series.select(F.max(ts)).scalar()
    cutoff = last - F.make_dt_interval(F.lit(days))
    df = series.withColumn("datetime", ts)
    train = drop_warmup(df.filter(F.col("datetime") <= cutoff))
    test = drop_warmup(df.filter(F.col("datetime") > cutoff))
    return train, test


def seasonal_naive(series: DataFrame) -> DataFrame:
    """Same hour last week as the prediction."""
    return series.withColumn("prediction", clip_nonneg("lag_168h"))


def add_demand_bucket(df: DataFrame, col: str = "trip_count") -> DataFrame:
    """P25: bucket label and its order (0 = lowest)."""
    label = order = None
    for i, (hi, name) in enumerate(DEMAND_BUCKETS):
        if hi is None:
            label, order = label.otherwise(name), order.otherwise(i)
        else:
            cond = F.col(col) <= hi
            label = F.when(cond, name) if label is None else label.when(cond, name)
            order = F.when(cond, i) if order is None else order.when(cond, i)
    return df.withColumns({"demand_bucket": label, "bucket_order": order})


def prediction_frame(scored: DataFrame) -> DataFrame:
    """S12 shape: the columns the evaluation tables keep."""
    return scored.select(
        ZONE, "datetime", "trip_count", "prediction", "is_rush_hour", "is_weekend",
        "pickup_hour",
    )


def _abs_err(y: str, p: str) -> Column:
    return F.abs(F.col(y) - F.col(p))


def _metric_cols(y: str = "trip_count", p: str = "prediction") -> list[Column]:
    err = F.col(y) - F.col(p)
    n = F.count(F.col(y))
    sse = F.sum(err * err)
    sst = F.var_pop(F.col(y)) * n
    r2 = (
        F.when(n < 2, F.lit(None).cast("double"))
        .when(sst == 0, F.when(sse == 0, 1.0).otherwise(0.0))
        .otherwise(1 - sse / sst)
    )
    denom = F.when(F.col(y) == 0, F.lit(1)).otherwise(F.col(y))
    return [
        F.avg(_abs_err(y, p)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        r2.alias("r2"),
        (F.avg(_abs_err(y, p) / denom) * 100).alias("mape"),
    ]


def forecast_metrics(preds: DataFrame) -> DataFrame:
    """MAE, RMSE, R^2 and MAPE (zero actual -> denominator 1), one row."""
    return preds.agg(F.count(F.lit(1)).alias("n"), *_metric_cols())


def mape_by_bucket(preds: DataFrame) -> DataFrame:
    """MAPE per demand bucket; every bucket is listed, empty ones with
    NULL."""
    spark = preds.sparkSession
    buckets = spark.createDataFrame(
        [(i, name) for i, (_, name) in enumerate(DEMAND_BUCKETS)],
        "bucket_order INT, demand_bucket STRING",
    )
    denom = F.when(F.col("trip_count") == 0, F.lit(1)).otherwise(F.col("trip_count"))
    per = (
        add_demand_bucket(preds)
        .groupBy("bucket_order")
        .agg((F.avg(_abs_err("trip_count", "prediction") / denom) * 100).alias("mape"))
    )
    return F.broadcast(buckets).join(per, on="bucket_order", how="left")


def zone_metrics(preds: DataFrame) -> DataFrame:
    """The A37 metrics per zone, rounded half-to-even to 2/2/4/2 places,
    as ``zone_id``, the smallest error first."""
    m = preds.groupBy(F.col(ZONE).alias("zone_id")).agg(*_metric_cols())
    return m.select(
        "zone_id",
        *[F.bround(F.col(c), n).alias(c) for c, n in ZONE_METRIC_PLACES.items()],
    ).orderBy("mae", "zone_id")


def actual_vs_predicted(preds: DataFrame, zone_id) -> DataFrame:
    """One zone's actual and predicted series in time order."""
    return (
        preds.filter(F.col(ZONE) == zone_id)
        .select("datetime", "trip_count", "prediction")
        .orderBy("datetime")
    )
