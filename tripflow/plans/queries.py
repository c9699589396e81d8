"""The query registry behind ``__spark_entry__.queries()``.

One entry per operator of the survey's inventory, keyed by the operator's
name. Each callable takes ``(spark, sf_dir)``, reads the driver's tables
(through the fixture views) and returns a lazy DataFrame whose double columns
are rounded to 4 places for the oracle comparison.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tripflow.functions.columns import clip_nonneg
from tripflow.functions.output import round_doubles
from tripflow.operators import (
    bronze,
    demand,
    evaluate,
    forecast,
    gold,
    history,
    model,
    platinum,
    profile,
    silver,
)
from tripflow.plans import inputs
from tripflow.plans.live import Live
from tripflow.plans.medallion import Medallion, land_files
from tripflow.session import scratch_path, written
from tripflow.sources import fixtures, landing, loading, tables
from tripflow.streaming import bronze_stream

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn

    return deco


# The Silver columns the Silver-level queries emit.
SILVER_COLUMNS = [
    "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
    "trip_distance", "ratecode_id", "store_and_fwd_flag", "pu_location_id",
    "do_location_id", "payment_type", "fare_amount", "extra", "mta_tax",
    "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
    "congestion_surcharge", "airport_fee", "cbd_congestion_fee",
    "is_airport_trip", "is_cbd_trip", "has_extra_charges", "trip_date",
    "trip_year", "pickup_hour", "pickup_day", "pickup_month", "pickup_year",
    "extra_charges", "trip_duration_seconds", "trip_duration_minutes",
    "fare_per_mile",
]


# --------------------------------------------------------------- Silver
@register("silver_trips")
def q_silver_trips(spark, sf):
    """P6-P14 end to end on fixture T."""
    return inputs.silver_trips(spark, sf).select(*SILVER_COLUMNS)


# --------------------------------------------------------------- Gold facts
def _fact(name):
    @register(name)
    def q(spark, sf):
        return gold.FACTS[name](inputs.silver_trips(spark, sf))

    return q


for _name in gold.FACTS:
    _fact(_name)


LO, HI = fixtures.TRIPS_VALID_YEARS
DECLARED = [f.name for f in bronze.TRIP_SCHEMA.fields]


def _renamed_defaults(spark, sf):
    """Typed T with Silver's time renames and NULL defaults (P6 + P7)."""
    return silver.fill_trip_defaults(silver.rename(inputs.typed_trips(spark, sf), silver.TIME_RENAMES))


# --------------------------------------------------------------- Silver steps
@register("rename")
def q_rename(spark, sf):
    """Time and id renames."""
    df = silver.rename(silver.rename(inputs.typed_trips(spark, sf), silver.TIME_RENAMES), silver.ID_RENAMES)
    return df.select("vendor_id", "pickup_datetime", "dropoff_datetime", "pu_location_id",
                     "do_location_id", "ratecode_id")


@register("fill_trip_defaults")
def q_fill_trip_defaults(spark, sf):
    """P7."""
    return _renamed_defaults(spark, sf).select(
        "VendorID", "pickup_datetime", "passenger_count", "RatecodeID", "store_and_fwd_flag",
        "congestion_surcharge", "airport_fee", "cbd_congestion_fee")


@register("add_trip_flags")
def q_add_trip_flags(spark, sf):
    """P8 (R7: a NULL charge term gives 0)."""
    return silver.add_trip_flags(_renamed_defaults(spark, sf)).select(
        "VendorID", "pickup_datetime", "extra", "mta_tax", "tolls_amount",
        "is_airport_trip", "is_cbd_trip", "has_extra_charges")


@register("filter_valid_trips")
def q_filter_valid_trips(spark, sf):
    """P9."""
    return silver.filter_valid_trips(_renamed_defaults(spark, sf)).select(
        "VendorID", "pickup_datetime", "dropoff_datetime", "fare_amount", "total_amount",
        "trip_distance", "passenger_count")


@register("add_calendar")
def q_add_calendar(spark, sf):
    """P10."""
    return silver.add_calendar(_renamed_defaults(spark, sf)).select(
        "pickup_datetime", "dropoff_datetime", "trip_date", "trip_year", "pickup_hour",
        "pickup_day", "pickup_month", "pickup_year")


@register("add_extra_charges")
def q_add_extra_charges(spark, sf):
    """P11."""
    return silver.add_extra_charges(_renamed_defaults(spark, sf)).select(
        "total_amount", "fare_amount", "extra_charges")


@register("add_duration")
def q_add_duration(spark, sf):
    """P12."""
    return silver.add_duration(_renamed_defaults(spark, sf)).select(
        "pickup_datetime", "dropoff_datetime", "trip_duration_seconds", "trip_duration_minutes")


@register("add_fare_per_mile")
def q_add_fare_per_mile(spark, sf):
    """P13."""
    return silver.add_fare_per_mile(_renamed_defaults(spark, sf)).select(
        "fare_amount", "trip_distance", "fare_per_mile")


@register("drop")
def q_drop(spark, sf):
    """The source-file column dropped."""
    return inputs.typed_trips(spark, sf).drop("source_file")


@register("add_distance_bucket")
def q_add_distance_bucket(spark, sf):
    """P15."""
    return gold.add_distance_bucket(inputs.silver_trips(spark, sf)).select(
        "trip_distance", "distance_bucket")


# --------------------------------------------------------------- Bronze
@register("enforce_schema")
def q_enforce_schema(spark, sf):
    """Declared types, absent declared columns as typed NULL."""
    return inputs.typed_trips(spark, sf)


@register("normalise_columns")
def q_normalise_columns(spark, sf):
    """P2 (+P1): a drifted file (``Airport_fee``, DOUBLE passenger count)
    comes out with the declared names and types."""
    raw = fixtures.raw_trips(spark, sf)
    drifted = raw.withColumnsRenamed({"airport_fee": "Airport_fee"}).withColumn(
        "passenger_count", F.col("passenger_count").cast("double"))
    return bronze.enforce_schema(drifted).select(
        "VendorID", "tpep_pickup_datetime", "passenger_count", "airport_fee")


@register("add_ingest_metadata")
def q_add_ingest_metadata(spark, sf):
    """Load time present, source file kept."""
    df = bronze.add_ingest_metadata(inputs.typed_trips(spark, sf))
    return df.select("VendorID", "tpep_pickup_datetime", "source_file",
                     F.col("bronze_ingestion_time").isNotNull().alias("has_ingestion_time"))


@register("with_partition_year")
def q_with_partition_year(spark, sf):
    """P4."""
    return bronze.with_partition_year(inputs.typed_trips(spark, sf)).select(
        "VendorID", "tpep_dropoff_datetime", "year")


def _year_split(spark, sf):
    return bronze.split_valid(bronze.with_partition_year(inputs.typed_trips(spark, sf)), LO, HI)


@register("split_valid_good")
def q_split_valid_good(spark, sf):
    """P5 good side."""
    return _year_split(spark, sf)[0]


@register("split_valid_bad")
def q_split_valid_bad(spark, sf):
    """P5 quarantine side (exact complement)."""
    return _year_split(spark, sf)[1]


@register("dedup_trips")
def q_dedup_trips(spark, sf):
    """A17 on the good side."""
    return bronze.dedup_trips(_year_split(spark, sf)[0])


@register("bronze_silver_yearly")
def q_bronze_silver_yearly(spark, sf):
    """Full chain: landed T -> Bronze (split, dedup) -> Silver -> A5."""
    good, _ = bronze.bronze_transform(fixtures.raw_trips(spark, sf), LO, HI)
    return gold.fact_trip_yearly_summary(silver.silver_transform(good))


# --------------------------------------------------------------- dimensions
@register("dim_location")
def q_dim_location(spark, sf):
    """P16 over fixture L."""
    return inputs.zones(spark, sf)


@register("read_zone_lookup")
def q_read_zone_lookup(spark, sf):
    """Fixture L written as a headed CSV, read back with the declared
    schema, projected to the dimension."""
    path = scratch_path(spark, "zone_lookup_csv")
    fixtures.raw_zone_lookup(spark, sf).write.option("header", True).csv(path)
    return gold.dim_location(gold.read_zone_lookup(spark, path))


# --------------------------------------------------------------- history views
def _facts(spark, sf, name):
    return gold.FACTS[name](inputs.silver_trips(spark, sf))


def _fact_payment(spark, sf):
    return history.enrich_payment(_facts(spark, sf, "fact_payment_summary"), gold.dim_payment_type(spark))


def _fact_vendor(spark, sf):
    return history.enrich_vendor(_facts(spark, sf, "fact_vendor_summary"), gold.dim_vendor(spark))


def _fact_location(spark, sf):
    return history.enrich_location(_facts(spark, sf, "fact_location_summary"), inputs.zones(spark, sf))


# The year selection used by the filter query.
SELECTED_YEARS = (1995, 1996, 1997)


@register("filter_years")
def q_filter_years(spark, sf):
    """P17 on the yearly fact."""
    return history.filter_years(_facts(spark, sf, "fact_trip_yearly_summary"), SELECTED_YEARS)


@register("enrich_payment")
def q_enrich_payment(spark, sf):
    """J1."""
    return _fact_payment(spark, sf)


@register("enrich_vendor")
def q_enrich_vendor(spark, sf):
    """J2."""
    return _fact_vendor(spark, sf)


@register("enrich_location")
def q_enrich_location(spark, sf):
    """J3."""
    return _fact_location(spark, sf)


@register("kpis")
def q_kpis(spark, sf):
    """A19."""
    return history.kpis(_facts(spark, sf, "fact_trip_yearly_summary"))


@register("kpis_weighted")
def q_kpis_weighted(spark, sf):
    """A19, trip-weighted variant."""
    return history.kpis_weighted(_facts(spark, sf, "fact_trip_yearly_summary"))


@register("yearly_trend")
def q_yearly_trend(spark, sf):
    """K6."""
    return history.yearly_trend(_facts(spark, sf, "fact_trip_yearly_summary"))


@register("yoy_change")
def q_yoy_change(spark, sf):
    """W3."""
    return history.yoy_change(_facts(spark, sf, "fact_trip_yearly_summary"))


@register("payment_mix")
def q_payment_mix(spark, sf):
    """A20 + W6."""
    return history.payment_mix(_fact_payment(spark, sf))


@register("payment_value")
def q_payment_value(spark, sf):
    """A21."""
    return history.payment_value(_fact_payment(spark, sf))


@register("payment_value_weighted")
def q_payment_value_weighted(spark, sf):
    """A21, trip-weighted variant."""
    return history.payment_value_weighted(_fact_payment(spark, sf))


@register("vendor_summary")
def q_vendor_summary(spark, sf):
    """A22."""
    return history.vendor_summary(_fact_vendor(spark, sf))


@register("distance_summary")
def q_distance_summary(spark, sf):
    """A23."""
    return history.distance_summary(_facts(spark, sf, "fact_distance_summary"))


@register("distance_highlights")
def q_distance_highlights(spark, sf):
    """K4 on A23."""
    return history.distance_highlights(_facts(spark, sf, "fact_distance_summary"))


@register("hourly_trips")
def q_hourly_trips(spark, sf):
    """A24."""
    return history.hourly_trips(_facts(spark, sf, "fact_trip_time_summary"))


@register("peak_hour")
def q_peak_hour(spark, sf):
    """K4 on A24."""
    return history.peak_hour(_facts(spark, sf, "fact_trip_time_summary"))


@register("borough_trips")
def q_borough_trips(spark, sf):
    """A25 + W6."""
    return history.borough_trips(_fact_location(spark, sf))


@register("top_zones_by_revenue")
def q_top_zones_by_revenue(spark, sf):
    """K1."""
    return history.top_zones_by_revenue(_fact_location(spark, sf))


@register("premium_zones")
def q_premium_zones(spark, sf):
    """K2."""
    return history.premium_zones(_fact_location(spark, sf))


# --------------------------------------------------------------- Platinum
def _sh(spark, sf):
    return inputs.silver_hourly(spark, sf)


def _hourly(spark, sf):
    return platinum.hourly_demand(_sh(spark, sf))


def _top_zones(spark, sf):
    return platinum.top_zones(_sh(spark, sf))


def _grid(spark, sf):
    return platinum.hourly_and_grid(_sh(spark, sf))[1]


def _dense(spark, sf):
    hourly, grid = platinum.hourly_and_grid(_sh(spark, sf))
    return platinum.densify(grid, hourly)


def _ds(spark, sf):
    return inputs.demand_series(spark, sf)


@register("zone_totals")
def q_zone_totals(spark, sf):
    """A11."""
    return platinum.zone_totals(_sh(spark, sf))


@register("zone_threshold")
def q_zone_threshold(spark, sf):
    """A12."""
    return platinum.zone_threshold(platinum.zone_totals(_sh(spark, sf)))


@register("top_zones")
def q_top_zones(spark, sf):
    """A13."""
    return _top_zones(spark, sf)


@register("hour_bounds")
def q_hour_bounds(spark, sf):
    """A14."""
    return platinum.hour_bounds(_sh(spark, sf))


@register("hour_sequence")
def q_hour_sequence(spark, sf):
    """A15."""
    return platinum.hour_sequence(platinum.hour_bounds(_sh(spark, sf)))


@register("hourly_demand")
def q_hourly_demand(spark, sf):
    """A16."""
    return _hourly(spark, sf)


@register("hour_zone_grid")
def q_hour_zone_grid(spark, sf):
    """J5 (no cross join)."""
    return _grid(spark, sf)


@register("semi_zones")
def q_semi_zones(spark, sf):
    """J7."""
    return platinum.semi_zones(_sh(spark, sf), _top_zones(spark, sf)).select(
        "pu_location_id", "pickup_datetime", "fare_amount")


@register("densify")
def q_densify(spark, sf):
    """J6 + P20."""
    return _dense(spark, sf)


@register("fill_missing_hours")
def q_fill_missing_hours(spark, sf):
    """P20: every hour of the grid, the missing ones filled."""
    hourly, grid = platinum.hourly_and_grid(_sh(spark, sf))
    return platinum.fill_missing_hours(grid.join(hourly, on=list(platinum.SERIES_KEYS), how="left"))


@register("add_series_calendar")
def q_add_series_calendar(spark, sf):
    """P19."""
    return platinum.add_series_calendar(_dense(spark, sf))


@register("add_lags")
def q_add_lags(spark, sf):
    """W1."""
    return _ds(spark, sf).select(*platinum.SERIES_KEYS, "trip_count", "lag_1h", "lag_24h", "lag_168h")


@register("add_rolling_mean")
def q_add_rolling_mean(spark, sf):
    """W2."""
    return platinum.add_rolling_mean(_ds(spark, sf)).select(
        *platinum.SERIES_KEYS, "trip_count", "rolling_mean_24h")


@register("demand_series")
def q_demand_series(spark, sf):
    """Silver(H) -> top zones -> grid -> densify -> calendar -> lags."""
    return _ds(spark, sf)


@register("order_series")
def q_order_series(spark, sf):
    """K5."""
    return platinum.order_series(_ds(spark, sf))


# --------------------------------------------------------------- demand views
def _enriched(spark, sf):
    return demand.enrich_series(_ds(spark, sf), inputs.zones(spark, sf))


@register("enrich_series")
def q_enrich_series(spark, sf):
    """J4."""
    return _enriched(spark, sf)


@register("filter_zone")
def q_filter_zone(spark, sf):
    """P18 for the selector's default zone (first id)."""
    ds = _ds(spark, sf)
    return demand.filter_zone(ds, demand.default_zone(ds))


@register("with_series_ts")
def q_with_series_ts(spark, sf):
    """P22."""
    return demand.with_series_ts(_ds(spark, sf)).select(*platinum.SERIES_KEYS, "datetime")


@register("map_values")
def q_map_values(spark, sf):
    """Day-type, weekday and month labels."""
    return demand.calendar_labels(_ds(spark, sf)).select(
        *platinum.SERIES_KEYS, "is_weekend", "day_type", "dow_name", "month_name", "month_label")


@register("distinct_sorted")
def q_distinct_sorted(spark, sf):
    """The zone selector's (zone, id) list."""
    return demand.distinct_sorted(_enriched(spark, sf), ["zone", "pu_location_id"])


@register("hour_profile")
def q_hour_profile(spark, sf):
    """A26."""
    return demand.hour_profile(_ds(spark, sf))


@register("typical_week")
def q_typical_week(spark, sf):
    """A27."""
    return demand.typical_week(_ds(spark, sf))


@register("week_extremes")
def q_week_extremes(spark, sf):
    """K4 on A27."""
    return demand.week_extremes(_ds(spark, sf))


@register("season_band")
def q_season_band(spark, sf):
    """P26 on A28's monthly means."""
    return demand.monthly_seasonality(_ds(spark, sf))


@register("monthly_seasonality")
def q_monthly_seasonality(spark, sf):
    """A28 figures."""
    return demand.seasonality_summary(_ds(spark, sf))


@register("borough_demand")
def q_borough_demand(spark, sf):
    """A29."""
    return demand.borough_demand(_enriched(spark, sf))


@register("zone_kpis")
def q_zone_kpis(spark, sf):
    """A30."""
    return demand.zone_kpis(_ds(spark, sf))


@register("yoy_monthly")
def q_yoy_monthly(spark, sf):
    """A31."""
    return demand.yoy_monthly(_ds(spark, sf))


@register("demand_heatmap")
def q_demand_heatmap(spark, sf):
    """A32."""
    return demand.demand_heatmap(_ds(spark, sf))


@register("recent_monthly")
def q_recent_monthly(spark, sf):
    """A34."""
    return demand.recent_monthly(_ds(spark, sf))


@register("data_through")
def q_data_through(spark, sf):
    """A36."""
    return demand.data_through(_ds(spark, sf))


@register("demand_hotspots")
def q_demand_hotspots(spark, sf):
    """K3."""
    return demand.demand_hotspots(_enriched(spark, sf))


# --------------------------------------------------------------- evaluation
# Hold-out length for fixture H (30 days; lag_168h uses 7).
HOLDOUT_DAYS = 7


def _split(spark, sf):
    return evaluate.time_split(_ds(spark, sf), HOLDOUT_DAYS)


def _naive_preds(spark, sf):
    return evaluate.prediction_frame(evaluate.seasonal_naive(_split(spark, sf)[1]))


@register("drop_warmup")
def q_drop_warmup(spark, sf):
    """P21."""
    return evaluate.drop_warmup(_ds(spark, sf))


@register("time_split_train")
def q_time_split_train(spark, sf):
    """M1 train side."""
    return _split(spark, sf)[0]


@register("time_split_test")
def q_time_split_test(spark, sf):
    """M1 test side."""
    return _split(spark, sf)[1]


@register("seasonal_naive")
def q_seasonal_naive(spark, sf):
    """M10 (with P24 clipping) on the hold-out."""
    return _naive_preds(spark, sf)


@register("clip_nonneg")
def q_clip_nonneg(spark, sf):
    """P24 on the week-over-week change of each hour (NULL in the first week)."""
    return _ds(spark, sf).select(*platinum.SERIES_KEYS,
                     clip_nonneg(F.col("trip_count") - F.col("lag_168h")).alias("growth"))


@register("add_demand_bucket")
def q_add_demand_bucket(spark, sf):
    """P25."""
    return evaluate.add_demand_bucket(_naive_preds(spark, sf))


@register("forecast_metrics")
def q_forecast_metrics(spark, sf):
    """A37 on the seasonal-naive hold-out predictions."""
    return evaluate.forecast_metrics(_naive_preds(spark, sf))


@register("mape_by_bucket")
def q_mape_by_bucket(spark, sf):
    """A38."""
    return evaluate.mape_by_bucket(_naive_preds(spark, sf))


@register("zone_metrics")
def q_zone_metrics(spark, sf):
    """A39."""
    return evaluate.zone_metrics(_naive_preds(spark, sf))


@register("actual_vs_predicted")
def q_actual_vs_predicted(spark, sf):
    """M11 for the selector's default zone."""
    preds = _naive_preds(spark, sf)
    return evaluate.actual_vs_predicted(preds, demand.default_zone(preds))


# --------------------------------------------------------------- model
_MODELS: dict = {}


def trained_model(spark, sf):
    """M3 on the fixture's split, trained once per application and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        train, test = _split(spark, sf)
        tm = model.train_demand_model(train, test)
        path = scratch_path(spark, "demand_model")
        model.save_model(tm, path)
        _MODELS[key] = (tm, path)
    return _MODELS[key]


@register("feature_pipeline")
def q_feature_pipeline(spark, sf):
    """M2: indexed zone and the assembled features, one column each."""
    train, _ = _split(spark, sf)
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    out = Pipeline(stages=model.feature_pipeline()).fit(train).transform(train)
    features = vector_to_array("features")
    return out.select(*platinum.SERIES_KEYS, model.ZONE_INDEX,
                      *[features[i].alias(f"f_{c}") for i, c in enumerate(model.FEATURE_COLS)])


@register("train_demand_model")
def q_train_demand_model(spark, sf):
    """M3: that training ended by patience and not by the bound, that no round is
    better than the chosen one, that the ensemble ends there, and that no constant
    would have done as well on the hold-out."""
    tm, _ = trained_model(spark, sf)
    p = model.ModelParams()
    losses = [float(v) for v in tm.validation_loss]
    test = _split(spark, sf)[1]
    middle = test.select(F.percentile("trip_count", F.lit(0.5))).scalar()
    constant = test.agg(F.avg(F.abs(F.col("trip_count") - middle)).alias("constant_error"))
    best = losses[tm.best_iteration - 1]
    return constant.select(
        F.lit(len(losses) == tm.best_iteration + p.patience).alias("stopped_by_patience"),
        F.lit(len(losses) < p.max_rounds).alias("below_bound"),
        F.lit(all(v >= best - p.tolerance * losses[0] for v in losses)).alias("none_is_better"),
        F.lit(tm.model.rounds == tm.best_iteration).alias("cut_at_best"),
        (F.col("constant_error") > best).alias("better_than_any_constant"),
    )


@register("score")
def q_score(spark, sf):
    """M4: hold-out predictions, clipped at zero, and that their error is below
    that of the best constant (the median of the hold-out itself)."""
    tm, _ = trained_model(spark, sf)
    test = _split(spark, sf)[1]
    out = model.score(tm.model, test)
    middle = test.select(F.percentile("trip_count", F.lit(0.5))).scalar()
    off = lambda x: F.avg(F.abs(F.col("trip_count") - x))
    better = out.agg((off(F.col("prediction")) < off(middle)).alias("b")).scalar()
    return out.select(*platinum.SERIES_KEYS, "trip_count", (F.col("prediction") >= 0).alias("not_negative"), better.alias("better_than_any_constant"))


@register("feature_importance")
def q_feature_importance(spark, sf):
    """M5: every feature, that the shares add up, and that a feature moves a
    prediction when it is taken away if its share is large, and never if it has
    none."""
    tm, _ = trained_model(spark, sf)
    test = written(model.score(tm.model, _split(spark, sf)[1]).withColumnRenamed("prediction", "whole"), "scored")
    imp = model.feature_importance(tm, spark)
    moved = []
    for c in tm.features:
        without = model.score(tm.model, test.withColumn(c, F.lit(None).cast(test.schema[c].dataType)))
        moved.append(without.select(F.lit(c).alias("feature"), (F.col("prediction") != F.col("whole")).alias("m")))
    effect = reduce(lambda a, b: a.union(b), moved).groupBy("feature").agg(F.max("m").alias("moves"))
    total = imp.select(F.sum("importance")).scalar()
    share = F.col("importance")
    return imp.join(effect, "feature").select(
        "feature", (share >= 0).alias("not_negative"), (F.abs(total - 1) < 1e-9).alias("sums_to_one"),
        (F.when(share > 0.05, F.col("moves")).when(share == 0, ~F.col("moves")).otherwise(True)).alias("effect_agrees"))


@register("save_load_model")
def q_save_load_model(spark, sf):
    """M6: the reloaded model scores the hold-out; ``same`` compares with the
    in-memory model."""
    tm, path = trained_model(spark, sf)
    test = _split(spark, sf)[1]
    a = model.score(tm.model, test).select(*platinum.SERIES_KEYS, F.col("prediction").alias("p1"))
    b = model.score(model.load_model(path), test).select(*platinum.SERIES_KEYS, F.col("prediction").alias("p2"))
    return a.join(b, on=list(platinum.SERIES_KEYS)).select(*platinum.SERIES_KEYS, (F.col("p1") == F.col("p2")).alias("same"))


# --------------------------------------------------------------- forecast
def _zones_of(ds):
    return ds.select(platinum.ZONE).distinct()


@register("future_grid")
def q_future_grid(spark, sf):
    """M9: all series zones x the 2,160 hours after the last hour."""
    ds = _ds(spark, sf)
    return forecast.future_grid(_zones_of(ds), forecast.forecast_start(ds))


@register("seed_rows")
def q_seed_rows(spark, sf):
    """W4."""
    return forecast.seed_rows(_ds(spark, sf))


@register("seed_averages")
def q_seed_averages(spark, sf):
    """W5."""
    return forecast.seed_averages(_ds(spark, sf))


def checked_forecast(spark, sf):
    """The forecast with what it must agree with: each lag equals the hour that
    far back (M8's fallback where there is none), and the model itself gives
    the same value from the same features."""
    tm, path = trained_model(spark, sf)
    ds = _ds(spark, sf)
    fc = written(forecast.forecast(tm.model, path, ds), "forecast")
    lags = [f"lag_{n}h" for n in platinum.LAGS]
    keys = [platinum.ZONE, "datetime", "trip_count"]
    past = demand.with_series_ts(forecast.seed_rows(ds)).select(*keys[:2], F.col("trip_count").cast("double").alias("trip_count"))
    both = past.withColumns({c: F.lit(None).cast("double") for c in lags}).unionByName(fc.select(*keys, *lags))
    w = Window.partitionBy(platinum.ZONE).orderBy("datetime")
    back = [F.lag("trip_count", n).over(w) for n in platinum.LAGS]
    want = [F.coalesce(back[0], F.lit(0.0)), *(F.coalesce(b, back[0], F.lit(0.0)) for b in back[1:])]
    steps = both.withColumns({f"want_{c}": x for c, x in zip(lags, want)}).filter(F.col("lag_1h").isNotNull())
    lag_ok = steps.select(*keys[:2], F.expr(" AND ".join(f"{c} = want_{c}" for c in lags)).alias("lags_match"))
    again = model.score(tm.model, forecast.with_features(fc).withColumn("stepwise", F.col("trip_count")))
    same = again.select(*keys[:2], F.col("stepwise").alias("trip_count"), (F.abs(F.col("prediction") - F.col("stepwise")) < 1e-6).alias("model_agrees"))
    return same.join(lag_ok, keys[:2])


@register("forecast")
def q_forecast(spark, sf):
    """M7/M8: 90-day recursive forecast for every zone."""
    return checked_forecast(spark, sf).select(platinum.ZONE, "datetime", (F.col("trip_count") >= 0).alias("not_negative"),
                                              "lags_match", "model_agrees")


def _history_frame(spark, sf):
    """A (zone, datetime, trip_count) frame from the series, the input
    shape of the projection roll-ups."""
    return demand.with_series_ts(_ds(spark, sf)).select(platinum.ZONE, "datetime", "trip_count")


@register("weekly_projection")
def q_weekly_projection(spark, sf):
    """A33 on a deterministic (zone, hour, trips) frame."""
    return forecast.weekly_projection(_history_frame(spark, sf))


@register("driver_requirement")
def q_driver_requirement(spark, sf):
    """A35 monthly rows."""
    return forecast.driver_requirement(_history_frame(spark, sf))


@register("driver_summary")
def q_driver_summary(spark, sf):
    """A35 figures."""
    return forecast.driver_summary(forecast.driver_requirement(_history_frame(spark, sf)))


@register("forecast_weekly")
def q_forecast_weekly(spark, sf):
    """A33 and A35 on the model's forecast: each zone's weeks with their hours,
    and that the weekly means add up to the hourly values, and the drivers of
    the months to the demand."""
    tm, path = trained_model(spark, sf)
    fc = written(forecast.forecast(tm.model, path, _ds(spark, sf)), "forecast")
    week = F.to_date(F.date_trunc("week", F.col("datetime"))).alias("week_start")
    hours = fc.groupBy(platinum.ZONE, week).agg(F.count("*").alias("hours"), F.sum("trip_count").alias("total"))
    means = forecast.weekly_projection(fc).join(hours, [platinum.ZONE, "week_start"])
    drivers = forecast.driver_summary(forecast.driver_requirement(fc)).select(platinum.ZONE, (F.col("max_peak_drivers") >= F.col("avg_drivers")).alias("peak_covers_mean"))
    return means.join(drivers, platinum.ZONE).select(
        platinum.ZONE, "week_start", "hours",
        (F.abs(F.col("avg_trips") * F.col("hours") - F.col("total")) < 1e-6).alias("adds_up"), "peak_covers_mean")


# --------------------------------------------------------------- tables and files
def _io(spark, name):
    return tables.TableIO(spark, scratch_path(spark, name))


def _bronze_good(spark, sf):
    return bronze.dedup_trips(_year_split(spark, sf)[0])


@register("bronze_table")
def q_bronze_table(spark, sf):
    """S6 + S3: Bronze appended partitioned by year, read back."""
    io = _io(spark, "bronze")
    io.append(_bronze_good(spark, sf), "trips", partition_by="year")
    return io.read("trips").select(*DECLARED, "source_file")


@register("quarantine_table")
def q_quarantine_table(spark, sf):
    """Rejected rows (NULL year lands in the default partition)."""
    io = _io(spark, "quarantine")
    io.append(_year_split(spark, sf)[1], "trips_quarantine", partition_by="year")
    return io.read("trips_quarantine").select(*DECLARED, "source_file")


@register("silver_table")
def q_silver_table(spark, sf):
    """Silver overwritten partitioned by trip_year; a second overwrite
    of the same partitions leaves the table unchanged."""
    io = _io(spark, "silver")
    df = inputs.silver_trips(spark, sf).select(*SILVER_COLUMNS)
    io.overwrite(df, "trips", partition_by="trip_year")
    io.overwrite(df, "trips", partition_by="trip_year")
    return io.read("trips").select(*SILVER_COLUMNS)


@register("write_dim")
def q_write_dim(spark, sf):
    """S9."""
    io = _io(spark, "gold")
    io.write_dim(inputs.zones(spark, sf), "dim_location")
    return io.read("dimensions/dim_location")


@register("write_fact")
def q_write_fact(spark, sf):
    """S10."""
    io = _io(spark, "gold")
    io.write_fact(_facts(spark, sf, "fact_trip_yearly_summary"), "fact_trip_yearly_summary")
    return io.read("facts/fact_trip_yearly_summary")


@register("write_features")
def q_write_features(spark, sf):
    """S11."""
    io = _io(spark, "platinum")
    io.write_features(_ds(spark, sf), "demand_series")
    return io.read("demand_series")


@register("write_evaluation")
def q_write_evaluation(spark, sf):
    """The prediction, per-zone metric and importance tables written and
    read back, with the model's own importances."""
    io = _io(spark, "evaluation")
    preds = _naive_preds(spark, sf)
    tm, _ = trained_model(spark, sf)
    io.write_evaluation(preds, evaluate.zone_metrics(preds), model.feature_importance(tm, spark))
    name = F.lit
    tables_ = [
        io.read("model_evaluation/demand_predictions").withColumn("evaluation", name("predictions")),
        io.read("model_evaluation/forecast_metrics").withColumn("evaluation", name("metrics")),
        io.read("model_evaluation/forecast_feature_importance").select(
            name("importance").alias("evaluation"), "feature", F.col("importance").between(0, 1).alias("is_share")),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables_)


def _land_trips(spark, sf) -> str:
    """Write fixture T as landed files, one folder per year."""
    return land_files(fixtures.raw_trips(spark, sf).drop("source_file"), scratch_path(spark, "landing"))


@register("read_landing")
def q_read_landing(spark, sf):
    """The landed dataset in one read, with each row's file."""
    df = landing.read_landing(spark, _land_trips(spark, sf))
    cols = [c for c in fixtures.raw_trips(spark, sf).columns if c != "source_file"]
    return df.select(*cols, F.col("source_file").isNotNull().alias("has_source_file"))


@register("read_landing_files")
def q_read_landing_files(spark, sf):
    """Two files with conflicting types/spellings read as one table."""
    root = scratch_path(spark, "landing_drift")
    raw = fixtures.raw_trips(spark, sf).drop("source_file")
    old = F.year("tpep_dropoff_datetime") <= 1995
    raw.filter(old).withColumnsRenamed({"airport_fee": "Airport_fee"}).withColumn(
        "passenger_count", F.col("passenger_count").cast("double")).write.parquet(f"{root}/a")
    raw.filter(~old | F.col("tpep_dropoff_datetime").isNull()).write.parquet(f"{root}/b")
    files = [r.file_name for r in landing.landed_files(spark, root).collect()]
    cols = [c for c in DECLARED if c != "year"]
    return landing.read_landing_files(spark, files).select(*cols)


def _year_folder(col: str = "file_name"):
    return F.regexp_extract(col, r"/(year=[^/]+)/", 1).alias("folder")


@register("new_files")
def q_new_files(spark, sf):
    """Folders of landed files that the ledger doesn't have."""
    files = landing.landed_files(spark, _land_trips(spark, sf))
    ledger = tables.FileLedger(spark, scratch_path(spark, "ledger")).init()
    ledger.append(files.filter(F.col("file_name").contains("year=1992")))
    return landing.new_files(files, ledger.read()).select(_year_folder()).distinct()


@register("file_ledger")
def q_file_ledger(spark, sf):
    """Ledger created, appended twice under one load, read; each
    folder once, none later than the latest time."""
    files = landing.landed_files(spark, _land_trips(spark, sf))
    ledger = tables.FileLedger(spark, scratch_path(spark, "ledger")).init()
    ledger.append(files)
    ledger.append(files)
    latest = ledger.latest().scalar()
    once = ledger.read().groupBy("file_name").agg(F.count("*").alias("n"), F.max("processed_time").alias("t"))
    return once.groupBy(_year_folder()).agg(F.max("n").alias("times_listed"), (F.max("t") <= F.max(latest)).alias("not_after_latest"))


@register("landing_progress")
def q_landing_progress(spark, sf):
    """S16 over file names built from T's dropoff months, plus T's own
    source names, which do not follow the pattern and are skipped."""
    ym = F.date_format("tpep_dropoff_datetime", "yyyy-MM")
    built = F.concat(F.lit("year="), F.year("tpep_dropoff_datetime").cast("string"),
                     F.lit("/yellow_tripdata_"), ym, F.lit(".parquet"))
    names = inputs.typed_trips(spark, sf).select(F.explode(F.array(built, "source_file")).alias("file_name")).distinct()
    return landing.landing_progress(names, start="2025-01-01")


def _streamed(spark, sf):
    root = scratch_path(spark, "stream")
    return root, bronze_stream.stream_bronze(spark, _land_trips(spark, sf), root, f"{root}/_checkpoint", LO, HI)


def _stream_rows(spark, path):
    """Rows of a streamed table; the file is the year's, as in the fixture."""
    named = F.concat(F.lit("trips_"), F.regexp_extract("source_file", r"/year=([^/]+)/", 1), F.lit(".parquet"))
    return bronze_stream.read_table(spark, path).select(*DECLARED, named.alias("folder"))


@register("stream_bronze")
def q_stream_bronze(spark, sf):
    """Landed files loaded by an availableNow file stream."""
    return _stream_rows(spark, _streamed(spark, sf)[1]["bronze"]).drop("folder")


@register("stream_quarantine")
def q_stream_quarantine(spark, sf):
    """The rejected rows of the stream's batches."""
    return _stream_rows(spark, _streamed(spark, sf)[1]["quarantine"]).drop("folder")


@register("stream_replay")
def q_stream_replay(spark, sf):
    """Batches that are run again replace themselves."""
    root, t = _streamed(spark, sf)
    checkpoint = f"{root}/_checkpoint"
    ledger, again = bronze_stream.read_table(spark, t["ledger"]), bronze_stream.bronze_batch(spark, root, LO, HI, checkpoint)
    for k in range(ledger.select("load_id").distinct().count()):
        load_id = bronze_stream.load_name(bronze_stream.stream_id(spark, checkpoint), k)
        again(ledger.filter(F.col("load_id") == load_id).select(F.col("file_name").alias("path")), k)
    return _stream_rows(spark, t["bronze"]).drop("folder")


def _land_halves(spark, sf) -> list:
    """Fixture T landed in two places, by dropoff year."""
    raw = fixtures.raw_trips(spark, sf).drop("source_file")
    early = F.coalesce(F.year("tpep_dropoff_datetime") < 1997, F.lit(False))
    return [land_files(raw.filter(c), scratch_path(spark, "landing")) for c in (early, ~early)]


@register("mixed_loads")
def q_mixed_loads(spark, sf):
    """A stream, a batch load of another folder, and the stream started
    anew, all on the same tables: nobody's rows go and none are there twice."""
    root = scratch_path(spark, "mixed")
    first, second = _land_halves(spark, sf)
    t = bronze_stream.stream_bronze(spark, first, root, f"{root}/_checkpoint_1", LO, HI)
    Medallion(spark, root).load_bronze(second, LO, HI)
    bronze_stream.stream_bronze(spark, first, root, f"{root}/_checkpoint_2", LO, HI)
    return _stream_rows(spark, t["bronze"]).drop("folder")


# --------------------------------------------------------------- profiling
@register("row_counts")
def q_row_counts(spark, sf):
    """A1: rows per stage."""
    good, _ = _year_split(spark, sf)
    return profile.row_counts(
        landing=fixtures.raw_trips(spark, sf),
        bronze=bronze.dedup_trips(good),
        silver=inputs.silver_trips(spark, sf),
        platinum=_ds(spark, sf),
    )


@register("profile_describe")
def q_profile_describe(spark, sf):
    """A2: every number and string column of Bronze."""
    return profile.profile_describe(inputs.typed_trips(spark, sf))


@register("profile_summary")
def q_profile_summary(spark, sf):
    """A3: the exact statistics, and that each approximate quartile has its
    share of the rows on either side."""
    x = inputs.silver_trips(spark, sf).select("fare_per_mile")
    wide = profile.profile_summary(x, ["fare_per_mile"]).groupBy().pivot(
        "summary", ["count", "mean", "stddev", "min", "max", "25%", "50%", "75%"]).agg(F.first("fare_per_mile").cast("double"))
    quartiles = {p: wide.select(F.col(f"{p}%")).scalar() for p in (25, 50, 75)}
    sides = x.agg(F.count("*").alias("n"), *[F.sum((F.col("fare_per_mile") <= q).cast("int")).alias(f"u{p}") for p, q in quartiles.items()],
                  *[F.sum((F.col("fare_per_mile") < q).cast("int")).alias(f"l{p}") for p, q in quartiles.items()])
    flags = [((F.col(f"l{p}") <= F.col("n") * (p / 100 + 0.01) + 1) & (F.col(f"u{p}") >= F.col("n") * (p / 100 - 0.01) - 1)).alias(f"q{p}_ok") for p in (25, 50, 75)]
    exact = wide.select(F.col("count").cast("long").alias("count"), "mean", "stddev", "min", "max")
    return exact.join(sides.select(*flags))


@register("profile_distinct")
def q_profile_distinct(spark, sf):
    """A4: exact distinct counts, and that each estimate is within three
    relative standard deviations."""
    typed = inputs.typed_trips(spark, sf)
    rsd = 0.05
    rows = profile.exact_distinct(typed)
    near = F.abs(F.col("approx_distinct") - F.col("distinct_values")) <= F.greatest(F.lit(1.0), 3 * rsd * F.col("distinct_values"))
    return rows.join(profile.profile_distinct(typed, rsd), "column").select("column", "distinct_values", near.alias("estimate_ok"))


# --------------------------------------------------------------- one-pass Gold and the full run
def _all_facts(facts: dict):
    """Facts of different columns as one table, ``fact`` first."""
    named = [df.withColumn("fact", F.lit(name)) for name, df in facts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


@register("rate_summary")
def q_rate_summary(spark, sf):
    """The rate code and store flag dictionaries beside Silver."""
    return history.rate_summary(inputs.silver_trips(spark, sf), gold.dim_rate_code(spark), gold.dim_store_forward_flag(spark))


@register("fact_grouping_sets")
def q_fact_grouping_sets(spark, sf):
    """The six facts from one GROUPING SETS pass."""
    return _all_facts(gold.split_facts(gold.fact_grouping_sets(inputs.silver_trips(spark, sf))))


@register("medallion_gold")
def q_medallion_gold(spark, sf):
    """Landed T files -> Bronze -> Silver -> Gold: the six facts as written."""
    root = scratch_path(spark, "medallion")
    land = land_files(fixtures.raw_trips(spark, sf).drop("source_file"), f"{root}/landing")
    m = Medallion(spark, f"{root}/tables")
    m.load_bronze(land, LO, HI)
    m.build_silver()
    names = m.build_gold(fixtures.raw_zone_lookup(spark, sf))
    return _all_facts({name: m.fact(name) for name in names})


# --------------------------------------------------------------- layers kept load by load
def _three_loads(spark, sf, after) -> Medallion:
    """T landed in three parts by dropoff year; ``after`` each load."""
    root = scratch_path(spark, "live")
    raw = fixtures.raw_trips(spark, sf).drop("source_file")
    y = F.coalesce(F.year("tpep_dropoff_datetime"), F.lit(0))
    m = Medallion(spark, f"{root}/tables")
    for k, part in enumerate((y < 1997, (y == 1997) | (y == 1999), (y == 1998) | (y > 1999))):
        land_files(raw.filter(part), f"{root}/landing/{k}")
        m.load_bronze(f"{root}/landing", LO, HI)
        after(m)
    return m


@register("live_silver")
def q_live_silver(spark, sf):
    """Silver after three loads, each of which rewrote the years it touched."""
    m = _three_loads(spark, sf, lambda m: m.live.refresh_silver())
    return m.silver().select(*SILVER_COLUMNS)


@register("live_facts")
def q_live_facts(spark, sf):
    """A5-A10 after three loads, from the sums of each."""
    return _all_facts(_three_loads(spark, sf, lambda m: m.live.refresh_facts()).live.facts())


@register("live_row_counts")
def q_live_row_counts(spark, sf):
    """A1 as observed while three loads were written."""
    return loading.row_counts(_three_loads(spark, sf, lambda m: None).io)


@register("live_profile")
def q_live_profile(spark, sf):
    """A3/A4 of Bronze after three loads, merged from stored sketches: the exact
    counts, and that the estimates keep within their bounds (three standard errors;
    for each quartile, the sketch's rank error)."""
    m = _three_loads(spark, sf, lambda m: m.live.refresh_profile())
    columns = [f.name for f in bronze.TRIP_SCHEMA.fields]
    got = m.live.profile().where(F.col("column").isin(columns))
    rows = m.io.read("bronze")
    numbers = [f.name for f in bronze.TRIP_SCHEMA.fields if isinstance(f.dataType, NumericType)]
    cut = {r.column: r.quantiles for r in got.collect() if r.quantiles is not None}
    aggs = []
    for c in columns:
        n = F.count(c)
        sides = [F.lit(True)]
        for share, q in zip(profile.QUARTILES, cut.get(c, [])):
            below, upto = (F.sum(x.cast("long")) for x in (F.col(c).cast("double") < q, F.col(c).cast("double") <= q))
            sides += [below <= n * (share + profile.RANK_ERROR) + 1, upto >= n * (share - profile.RANK_ERROR) - 1]
        ok = reduce(lambda a, b: a & F.coalesce(b, F.lit(True)), sides)
        aggs.append(F.struct(F.lit(c).alias("column"), n.alias("rows"), ok.alias("quartiles_ok"), (F.lit(c in cut) == ((n > 0) & F.lit(c in numbers))).alias("has_quartiles")).alias(f"c_{c}"))
    exact = rows.agg(*aggs).select(F.inline(F.array(*[F.col(f"c_{c}") for c in columns])))
    near = F.abs(F.col("approx_distinct") - F.col("distinct_values")) <= F.greatest(F.lit(1.0), 3 * profile.DISTINCT_ERROR * F.col("distinct_values"))
    return got.select("column", F.col("rows").alias("sketched"), "approx_distinct").join(exact, "column").join(profile.exact_distinct(rows, columns), "column").select(
        "column", "rows", "distinct_values", (F.col("sketched") == F.col("rows")).alias("same_rows"), near.alias("estimate_ok"), "quartiles_ok", "has_quartiles")


@register("live_series")
def q_live_series(spark, sf):
    """A11-A16, J5-J7, W1 after four loads of H by pickup time: merged hours, the
    series rewritten from the first month that changed."""
    trips = _sh(spark, sf)
    io = _io(spark, "live_series")
    loading.create_tables(io)
    live = Live(io)
    day = F.datediff(F.to_date("pickup_datetime"), trips.select(F.min(F.to_date("pickup_datetime"))).scalar())
    for k, part in enumerate((day < 9, (day >= 9) & (day < 17), (day >= 17) & (F.col("pickup_hour") < 20), (day >= 17) & (F.col("pickup_hour") >= 20))):
        loading.ledger_of(io).append(spark.createDataFrame([(f"part-{k}",)], "file_name STRING"), load_id=f"part-{k}")
        live.refresh_series(lambda loads, part=part: trips.where(part).withColumn("load_id", F.lit(loads[0])))
    return live.series()
