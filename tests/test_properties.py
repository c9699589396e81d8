"""Properties on the fixtures (sf0.001), and the property-checked operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tripflow.operators import bronze, demand, evaluate, forecast, history, model, platinum, profile
from tripflow.plans import inputs
from tripflow.plans.queries import REGISTRY
from tripflow.session import scratch_path
from tripflow.sources import fixtures, landing, tables
from tripflow.streaming import bronze_stream

LO, HI = fixtures.TRIPS_VALID_YEARS


def test_split_good_union_bad_is_input(spark):
    df = bronze.with_partition_year(inputs.typed_trips(spark, SMALL))
    good, bad = bronze.split_valid(df, LO, HI)
    assert good.count() + bad.count() == df.count()
    assert good.unionByName(bad).exceptAll(df).count() == 0


def test_grid_is_zones_times_hours_with_unique_key(spark):
    sh = inputs.silver_hourly(spark, SMALL)
    zones = platinum.top_zones(sh)
    b = platinum.hour_bounds(sh).first()
    n_hours = int((b["end"] - b["start"]).total_seconds() // 3600) + 1
    ds = inputs.demand_series(spark, SMALL)
    assert ds.count() == zones.count() * n_hours
    assert ds.select(*platinum.SERIES_KEYS).distinct().count() == ds.count()


def test_series_counts_all_trips_of_chosen_zones(spark):
    sh = inputs.silver_hourly(spark, SMALL)
    chosen = platinum.semi_zones(sh, platinum.top_zones(sh)).count()
    assert inputs.demand_series(spark, SMALL).agg(F.sum("trip_count")).first()[0] == chosen


def test_lag_equals_value_n_hours_earlier(spark):
    ds = inputs.demand_series(spark, SMALL).withColumn("ts", platinum.series_ts())
    for n in platinum.LAGS:
        prev = ds.select("pu_location_id", (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(n))).alias("ts"),
                         F.col("trip_count").alias("prev"))
        j = ds.join(prev, ["pu_location_id", "ts"], "left")
        bad = j.filter(~F.col(f"lag_{n}h").eqNullSafe(F.col("prev"))).count()
        assert bad == 0, n


def test_train_and_test_are_disjoint(spark):
    train, test = evaluate.time_split(inputs.demand_series(spark, SMALL), 7)
    keys = ["pu_location_id", "datetime"]
    assert train.select(*keys).intersect(test.select(*keys)).count() == 0
    assert train.agg(F.max("datetime")).first()[0] < test.agg(F.min("datetime")).first()[0]


@pytest.mark.parametrize("name", ["payment_mix", "borough_trips"])
def test_shares_sum_to_one(spark, name):
    s = REGISTRY[name](spark, SMALL).agg(F.sum("trip_share")).first()[0]
    assert abs(s - 1.0) < 1e-3


def test_distinct_estimate_within_bounds(spark):
    df = inputs.typed_trips(spark, SMALL)
    rsd = 0.05
    est = {r.column: r.approx_distinct for r in profile.profile_distinct(df, rsd).collect()}
    for c in ("VendorID", "PULocationID", "fare_amount", "source_file"):
        exact = df.select(c).distinct().count() - (1 if df.filter(F.col(c).isNull()).count() else 0)
        assert abs(est[c] - exact) <= max(1, 3 * rsd * exact), c


def test_summary_has_quartiles(spark):
    rows = {r.summary: r for r in profile.profile_summary(inputs.silver_trips(spark, SMALL), ["fare_per_mile"]).collect()}
    assert {"count", "mean", "25%", "50%", "75%", "min", "max"} <= set(rows)


def test_read_landing_files_aligns_drifting_files(spark):
    df = REGISTRY["read_landing_files"](spark, SMALL)
    assert df.count() == fixtures.raw_trips(spark, SMALL).count()
    assert dict(df.dtypes)["passenger_count"] == "bigint"


def test_ledger_and_new_files(spark):
    new = {r.folder for r in REGISTRY["new_files"](spark, SMALL).collect()}
    assert new and "year=1992" not in new
    assert all(r.times_listed == 1 for r in REGISTRY["file_ledger"](spark, SMALL).collect())


def test_stream_is_incremental_and_replay_safe(spark):
    src = scratch_path(spark, "landing_stream")
    raw = fixtures.raw_trips(spark, SMALL).drop("source_file")
    y = F.year("tpep_dropoff_datetime")
    raw.filter(y <= 1995).write.parquet(f"{src}/year=early")
    root = scratch_path(spark, "stream_test")
    ck = f"{root}/_checkpoint"
    t = bronze_stream.stream_bronze(spark, src, root, ck, LO, HI)
    read = lambda name: bronze_stream.read_table(spark, t[name])
    assert read("bronze").count() == 0 and read("quarantine").count() == raw.filter(y <= 1995).count()
    # A second landing arrives, with a column more; a re-run picks up only it.
    late = raw.filter((y > 1995) | y.isNull())
    late.repartition(3, *bronze.DEDUP_KEYS).withColumn("surge", F.lit(1.5)).write.parquet(f"{src}/year=late")
    bronze_stream.stream_bronze(spark, src, root, ck, LO, HI)
    distinct = late.filter(y.between(LO, HI)).select(*bronze.DEDUP_KEYS).distinct().count()
    assert read("bronze").count() == distinct
    assert read("bronze").filter("surge = 1.5").count() == distinct
    total = read("bronze").count(), read("quarantine").count()
    # Running again with nothing new changes nothing.
    bronze_stream.stream_bronze(spark, src, root, ck, LO, HI)
    assert total == (read("bronze").count(), read("quarantine").count())
    # Replaying batch 0 by hand replaces its own partitions instead of appending.
    first = bronze_stream.load_name(bronze_stream.stream_id(spark, ck), 0)
    files = read("ledger").filter(F.col("load_id") == first).select(F.col("file_name").alias("path"))
    assert files.count() > 0
    bronze_stream.bronze_batch(spark, root, LO, HI, ck)(files, 0)
    assert total == (read("bronze").count(), read("quarantine").count())


@pytest.mark.parametrize("fail_at", ["bronze", "quarantine", "_processed_files"])
def test_a_load_that_fails_is_repeated_without_doubles(spark, monkeypatch, fail_at):
    from tripflow.plans.medallion import Medallion, land_files

    root = scratch_path(spark, "retry")
    raw = fixtures.raw_trips(spark, SMALL).drop("source_file")
    land = land_files(raw, f"{root}/landing")
    m = Medallion(spark, f"{root}/tables")
    good = tables.TableIO.overwrite

    def fails(self, df, name, *a, **k):
        if name == fail_at:
            raise RuntimeError("lost")
        return good(self, df, name, *a, **k)

    monkeypatch.setattr(tables.TableIO, "overwrite", fails)
    with pytest.raises(RuntimeError):
        m.load_bronze(land, LO, HI)
    monkeypatch.setattr(tables.TableIO, "overwrite", good)
    # More lands before the retry.
    raw.limit(5).write.parquet(f"{land}/year=more")
    assert m.load_bronze(land, LO, HI) > 0
    y = F.year("tpep_dropoff_datetime")
    keys = raw.filter(y.between(LO, HI)).select(*bronze.DEDUP_KEYS).distinct()
    extra = raw.limit(5)
    n_extra = extra.filter(y.between(LO, HI)).select(*bronze.DEDUP_KEYS).distinct().count()
    assert m.io.read("bronze").count() == keys.count() + n_extra
    rejected = ~F.coalesce(y.between(LO, HI), F.lit(False))
    assert m.io.read("quarantine").count() == raw.filter(rejected).count() + extra.filter(rejected).count()


def test_a_corrupt_file_is_set_aside(spark):
    from tripflow.plans.medallion import Medallion, land_files

    root = scratch_path(spark, "corrupt")
    land = land_files(fixtures.raw_trips(spark, SMALL).drop("source_file"), f"{root}/landing")
    m = Medallion(spark, f"{root}/tables")
    with open(f"{land}/year=1996/broken.parquet", "wb") as f:
        f.write(b"PAR1 not a parquet file PAR1")
    n = landing.landed_files(spark, land).count()
    assert m.load_bronze(land, LO, HI) == n - 1
    failed = m.io.read("_failed_files").collect()
    assert len(failed) == 1 and "broken.parquet" in failed[0].file_name and failed[0].error
    rows = m.io.read("bronze").count()
    # The next run tries it again, and finds it mended.
    assert rows > 0 and m.load_bronze(land, LO, HI) == 0
    assert m.io.read("_failed_files").select("load_id").distinct().count() == 2
    raw = fixtures.raw_trips(spark, SMALL).drop("source_file").filter(F.year("tpep_dropoff_datetime") == 1996).limit(7)
    raw.coalesce(1).write.parquet(f"{root}/mended")
    import glob
    import shutil

    shutil.copy(glob.glob(f"{root.removeprefix('file:')}/mended/part-*.parquet")[0], f"{land}/year=1996/broken.parquet")
    assert m.load_bronze(land, LO, HI) == 1
    assert m.io.read("bronze").count() == rows + raw.select(*bronze.DEDUP_KEYS).distinct().count()
    assert m.load_bronze(land, LO, HI) == 0


def test_a_file_with_broken_rows_is_set_aside(spark):
    from tripflow.plans.medallion import Medallion, land_files

    root = scratch_path(spark, "corrupt_rows")
    land = land_files(fixtures.raw_trips(spark, SMALL).drop("source_file"), f"{root}/landing")
    m = Medallion(spark, f"{root}/tables")
    files = [r.file_name for r in landing.landed_files(spark, land).collect()]
    victim = next(f for f in files if "year=1996" in f)
    with open(victim.removeprefix("file:"), "r+b") as f:  # the footer stays whole
        f.seek(8)
        f.write(b"\xff" * 400)
    crc = victim.removeprefix("file:").rpartition("/")
    import os

    if os.path.exists(f"{crc[0]}/.{crc[2]}.crc"):
        os.remove(f"{crc[0]}/.{crc[2]}.crc")
    assert m.load_bronze(land, LO, HI) == len(files) - 1
    assert [r.file_name for r in m.io.read("_failed_files").collect()] == [victim]


def test_loads_of_different_sources_stay_apart(spark):
    from tripflow.plans.medallion import Medallion, land_files

    root = scratch_path(spark, "mixed_test")
    raw = fixtures.raw_trips(spark, SMALL).drop("source_file")
    early = F.coalesce(F.year("tpep_dropoff_datetime") < 1997, F.lit(False))
    lands = [land_files(raw.filter(c), f"{root}/landing_{k}") for k, c in enumerate((early, ~early))]
    bronze_stream.stream_bronze(spark, lands[0], f"{root}/t", f"{root}/ck1", LO, HI)
    m = Medallion(spark, f"{root}/t")
    count = lambda: (m.io.read("bronze").count(), m.ledger.read().count(), m.ledger.read().select("file_name").distinct().count())
    before = count()
    assert before[0] > 0
    assert m.load_bronze(lands[1], LO, HI) > 0
    both = count()
    assert both[0] > before[0] and both[1] == both[2] > before[1]
    # The same folder by a new stream, and by a batch load: committed already.
    bronze_stream.stream_bronze(spark, lands[0], f"{root}/t", f"{root}/ck2", LO, HI)
    assert m.load_bronze(lands[0], LO, HI) == 0 and count() == both


def test_only_changed_folders_are_listed(spark):
    from tripflow.plans.medallion import Medallion, land_files
    from tripflow.sources import loading
    from tripflow.sources.storage import Storage

    root = scratch_path(spark, "listing")
    raw = fixtures.raw_trips(spark, SMALL).drop("source_file")
    land = land_files(raw, f"{root}/landing")
    store = Storage(spark)
    files, marks, listed = store.changed(land, {}, settled_ms=-1)
    folders = len({f.rpartition("/")[0] for f in files}) + 1
    assert listed == folders == len(marks) and {f for f in files if f.endswith(".parquet")} == {r.file_name.replace("file:///", "file:/") for r in landing.landed_files(spark, land).collect()}
    assert store.changed(land, marks, settled_ms=-1) == ([], marks, 0)
    raw.limit(3).coalesce(1).write.mode("append").parquet(f"{land}/year=1996")
    raw.limit(3).coalesce(1).write.parquet(f"{land}/year=new/month=1")
    again, _, listed = store.changed(land, marks, settled_ms=-1)
    assert listed == 4  # the root, year=1996, year=new, month=1
    assert {f.rpartition("/")[0].rpartition("listing")[2].partition("/landing/")[2] for f in again} == {"year=1996", "year=new/month=1"}
    # A crash between plan and marks: the next run lists again and plans nothing twice.
    m = Medallion(spark, f"{root}/tables")
    loading.plan_landing(m.io, land, 4)
    m.io.overwrite(m.io.read("_landing_folders").limit(0), "_landing_folders", "landing")
    n = landing.landed_files(spark, land).count()
    assert len(loading.open_loads(m.io)) > 1
    assert m.load_bronze(land, LO, HI, files_a_load=4) == n and m.load_bronze(land, LO, HI) == 0
    assert m.ledger.read().count() == m.ledger.read().select("file_name").distinct().count() == n


def test_footers_are_read_by_executors(spark, monkeypatch):
    root = scratch_path(spark, "footers")
    raw = fixtures.raw_trips(spark, SMALL).drop("source_file").limit(40)
    for k in range(6):
        raw.withColumn("passenger_count", F.col("passenger_count").cast("double" if k % 2 else "long")).coalesce(1).write.parquet(f"{root}/{k}")
    files = [r.file_name for r in landing.landed_files(spark, root).collect()]
    asked = []
    real = landing._own_schema
    monkeypatch.setattr(landing, "_own_schema", lambda s, p: asked.append(p) or real(s, p))
    schemas, failed = landing.read_schemas(spark, files)
    assert not failed and len(asked) == 2 and len(schemas) == 6
    assert all(schemas[f]["passenger_count"].dataType.simpleString() == ("double" if int(f.split("/")[-2]) % 2 else "bigint") for f in files)


def test_a_schema_that_is_half_written_is_not_seen(spark, monkeypatch):
    from tripflow.sources.storage import Storage

    io = tables.TableIO(spark, scratch_path(spark, "io_schema"))
    df = spark.createDataFrame([(1, "a")], "x INT, y STRING")
    io.overwrite(df, "t")
    jobs = spark.sparkContext.statusTracker()
    assert io.schema("t").names == ["x", "y"]

    def crash(self, path, text):
        raise OSError("lost")

    with monkeypatch.context() as mp:
        mp.setattr(Storage, "write_text", crash)
        io.overwrite(df, "t")  # nothing to write: the schema is the same
        with pytest.raises(OSError):
            io.append(df.withColumn("z", F.lit(1)), "t")
    assert io.read("t").columns == ["x", "y"] and io.read("t").count() == 1 and jobs is not None
    io.append(df.withColumn("z", F.lit(1)), "t")
    assert io.read("t").columns == ["x", "y", "z"] and io.read("t").filter("z IS NULL").count() == 1


def test_row_counts_are_observed_not_read(spark):
    from tripflow.plans.medallion import Medallion, land_files
    from tripflow.sources import loading

    root = scratch_path(spark, "observed")
    land = land_files(fixtures.raw_trips(spark, SMALL).drop("source_file"), f"{root}/landing")
    m = Medallion(spark, f"{root}/tables")
    m.load_bronze(land, LO, HI, files_a_load=5)
    got = {r.stage: r.row_count for r in loading.row_counts(m.io).collect()}
    assert got["bronze"] == m.io.read("bronze").count() > 0 and got["quarantine"] == m.io.read("quarantine").count() > 0


def test_tables_without_rows_and_with_fewer_partitions(spark):
    io = tables.TableIO(spark, scratch_path(spark, "io_empty"))
    df = spark.createDataFrame([(1, 2023), (2, 2024)], "x INT, year INT")
    io.append(df.limit(0), "t", partition_by="year")
    assert io.read("t").count() == 0 and io.read("t").columns == ["x", "year"]
    io.overwrite(df, "t", partition_by="year")
    io.overwrite(df.filter("year = 2024"), "t", partition_by="year", only_partitions=True)
    assert {r.year for r in io.read("t").collect()} == {2023, 2024}
    io.overwrite(df.filter("year = 2024"), "t", partition_by="year")
    assert {r.year for r in io.read("t").collect()} == {2024}
    io.append(df.withColumn("more", F.lit("a")), "t", partition_by="year")
    assert io.read("t").filter("more = 'a'").count() == 2
    with pytest.raises(FileNotFoundError):
        io.read("nothing")


def test_checkpoint_folder_must_be_named_on_a_cluster():
    from types import SimpleNamespace

    from tripflow.session import checkpoint_root

    for master in ("yarn", "local-cluster[2,1,1024]"):
        context = SimpleNamespace(getCheckpointDir=lambda: None, master=master)
        with pytest.raises(ValueError):
            checkpoint_root(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=context))


def test_medallion_pins_utc(spark):
    from tripflow.plans.medallion import Medallion

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        Medallion(spark, scratch_path(spark, "zone"))
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        # Clocks went forward in this night; the hourly grid has no gap.
        hours = spark.sql("SELECT explode(sequence(timestamp'2024-03-10 00:00', timestamp'2024-03-10 05:00', interval 1 hour)) h")
        assert hours.select(F.hour("h")).distinct().count() == 6
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_clip_keeps_missing_values(spark):
    from tripflow.functions.columns import clip_nonneg

    df = spark.createDataFrame([(None,), (-1.0,), (2.0,)], "x DOUBLE").select(clip_nonneg("x").alias("y"))
    assert [r.y for r in df.collect()] == [None, 0.0, 2.0]


def test_views_are_in_order(spark):
    trips = [r.total_trips for r in REGISTRY["borough_trips"](spark, SMALL).collect()]
    assert trips == sorted(trips, reverse=True)
    mae = [r.mae for r in REGISTRY["zone_metrics"](spark, SMALL).collect()]
    assert mae == sorted(mae)


@pytest.fixture(scope="module")
def small_model(spark):
    series = inputs.demand_series(spark, SMALL).persist()
    train, test = evaluate.time_split(series, 7)
    p = model.ModelParams(max_rounds=4, num_leaves=8)
    tm = model.train_demand_model(train, test, p)
    path = scratch_path(spark, "test_model")
    model.save_model(tm, path)
    yield series, train, test, tm, path
    series.unpersist()


def test_model_reload_scores_equal(spark, small_model):
    _, _, test, tm, path = small_model
    a = model.score(tm.model, test).select("pu_location_id", "datetime", "prediction")
    b = model.score(model.load_model(path), test).select("pu_location_id", "datetime",
                                                          F.col("prediction").alias("p2"))
    j = a.join(b, ["pu_location_id", "datetime"])
    assert j.count() == test.count()
    assert j.filter(F.col("prediction") != F.col("p2")).count() == 0
    assert model.model_features(model.load_model(path)) == model.FEATURE_COLS
    imp = model.feature_importance(tm, spark).collect()
    assert len(imp) == len(model.FEATURE_COLS) and abs(sum(r.importance for r in imp) - 1) < 1e-6


def test_saved_trees_equal_the_scores(spark, small_model):
    _, _, test, tm, path = small_model
    trees = model.load_model(path)
    labels = {lbl: i for i, lbl in enumerate(trees.labels)}
    rows = model.score(tm.model, test).toPandas()
    x = rows[model.FEATURE_COLS].astype(float).to_numpy()
    x[:, 0] = [labels.get(str(z), len(labels)) for z in rows["pu_location_id"]]
    assert np.abs(np.maximum(trees.predict(x), 0.0) - rows["prediction"].to_numpy()).max() < 1e-9


def test_forecast_equals_plain_steps(spark, small_model):
    """Two zones x 200 hours, step by step, one with too few hours for a lag
    and with missing counts."""
    series, _, _, tm, path = small_model
    zones = [r[0] for r in series.select("pu_location_id").distinct().orderBy("pu_location_id").limit(2).collect()]
    two = series.filter(F.col("pu_location_id").isin(zones))
    hour = platinum.series_ts()
    last = two.select(F.max(hour)).first()[0]
    recent = hour > F.lit(last) - F.make_dt_interval(F.lit(4))
    gap = hour == F.lit(last) - F.make_dt_interval(F.lit(0), F.lit(30))
    two = two.filter((F.col("pu_location_id") == zones[0]) | recent).withColumn("trip_count", F.when(~gap, F.col("trip_count")))
    fc = forecast.forecast(tm.model, path, two, hours=200).toPandas().sort_values(["pu_location_id", "datetime"])
    trees = model.load_model(path)
    labels = trees.labels
    calendar = forecast.horizon_calendar(spark, forecast.forecast_start(two), 200)
    history = demand.with_series_ts(forecast.seed_rows(two)).select("pu_location_id", "datetime", "trip_count", *forecast.AVG_COLS).toPandas()
    for zone in zones:
        own = history[history["pu_location_id"] == zone].sort_values("datetime")
        known = [None if v != v else float(v) for v in own["trip_count"].astype(float)]
        means = own.tail(forecast.SEED_AVG_ROWS)[list(forecast.AVG_COLS)].astype(float).mean()
        got = fc[fc["pu_location_id"] == zone]["trip_count"].to_numpy()
        for t in range(200):
            value = {n: known[len(known) - n] if len(known) >= n else None for n in (1, 24, 168)}
            one = 0.0 if value[1] is None else value[1]
            row = {f"lag_{n}h": one if v is None else v for n, v in value.items()}
            row |= {c: float(calendar[c].iloc[t]) for c in calendar.columns if c in model.FEATURE_COLS}
            row |= {c: means[c] for c in forecast.AVG_COLS} | {"pu_location_id": labels.index(str(zone)) if str(zone) in labels else len(labels)}
            y = max(float(trees.predict(np.array([[row[c] for c in model.FEATURE_COLS]]))[0]), 0.0)
            assert abs(got[t] - y) < 1e-9, (zone, t)
            known.append(y)


@pytest.mark.parametrize("leak_free", [False, True])
def test_model_beats_last_week_on_busy_zones(spark, leak_free):
    """Counts in the hundreds with a daily shape, a trend and noise."""
    import datetime as dt
    import math
    import random

    rng = random.Random(1)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for zone in (1, 2, 3):
        for h in range(24 * 35):
            t = start + dt.timedelta(hours=h)
            level = 150 * zone * (1.2 + math.sin(2 * math.pi * t.hour / 24)) * (1 + h / 3000) + rng.gauss(0, 15 * zone)
            rows.append((zone, t.date(), t.hour, max(0, int(level)), 10.0, 2.0, 1.5))
    base = spark.createDataFrame(rows, "pu_location_id BIGINT, trip_date DATE, pickup_hour INT, trip_count BIGINT, avg_fare DOUBLE, avg_distance DOUBLE, avg_passengers DOUBLE")
    series = platinum.add_lags(platinum.add_series_calendar(base))
    how = {"learning_rate": 0.2, "patience": 10, "num_leaves": 31}
    params = model.ModelParams.leak_free(**how) if leak_free else model.ModelParams(**how)
    if leak_free:
        series = model.add_lagged_averages(series)
    train, test = evaluate.time_split(series, 7)
    fit, valid = model.validation_split(train, 4) if leak_free else (train, test)
    tm = model.train_demand_model(fit, valid, params)
    assert len(tm.validation_loss) == tm.best_iteration + params.patience < params.max_rounds
    mine = evaluate.forecast_metrics(evaluate.prediction_frame(model.score(tm.model, test))).first()
    naive = evaluate.forecast_metrics(evaluate.prediction_frame(evaluate.seasonal_naive(test))).first()
    assert mine.mae < naive.mae and mine.rmse < naive.rmse


def test_forecast_covers_horizon_for_every_zone(spark, small_model):
    series, _, _, tm, path = small_model
    fc = forecast.forecast(tm.model, path, series, hours=forecast.HORIZON_HOURS)
    per = {r.pu_location_id: r.n for r in fc.groupBy("pu_location_id").agg(F.count("*").alias("n")).collect()}
    zones = {r.pu_location_id for r in series.select("pu_location_id").distinct().collect()}
    assert set(per) == zones and set(per.values()) == {forecast.HORIZON_HOURS}
    assert fc.filter(F.col("trip_count") < 0).count() == 0
    last = series.select(F.max(platinum.series_ts())).first()[0]
    assert fc.agg(F.min("datetime")).first()[0] == last + __import__("datetime").timedelta(hours=1)
    weekly = forecast.weekly_projection(fc)
    assert weekly.count() >= len(zones) * 13


def test_tables_overwrite_is_idempotent(spark):
    io = tables.TableIO(spark, scratch_path(spark, "io"))
    df = inputs.silver_trips(spark, SMALL)
    io.overwrite(df, "s", partition_by="trip_year")
    io.overwrite(df, "s", partition_by="trip_year")
    assert io.read("s").count() == df.count()


def test_landing_progress_skips_malformed_and_rolls_year(spark):
    names = spark.createDataFrame(
        [("year=2025/yellow_tripdata_2025-12.parquet",), ("year=2025/yellow_tripdata_2025-xx.parquet",),
         ("notes.txt",)], "file_name STRING")
    r = landing.landing_progress(names, start="2025-01-01").first()
    assert (r.latest_label, r.next_label) == ("2025-12", "2026-01")
    empty = spark.createDataFrame([], "file_name STRING")
    r = landing.landing_progress(empty, start="2025-01-01").first()
    assert r.latest_month is None and r.next_label == "2025-01"


def test_kpis_unweighted_vs_weighted(spark):
    a = REGISTRY["kpis"](spark, SMALL).first()
    b = REGISTRY["kpis_weighted"](spark, SMALL).first()
    assert a.total_trips == b.total_trips
    fy = REGISTRY["fact_trip_yearly_summary"](spark, SMALL)
    assert abs(history.kpis(fy).first().avg_trip_value - a.avg_trip_value) < 1e-3


def test_one_pass_facts_equal_single_facts(spark):
    from tripflow.functions.output import round_doubles as rd
    from tripflow.operators import gold

    s = inputs.silver_trips(spark, SMALL)
    facts = gold.split_facts(gold.fact_grouping_sets(s))
    for name, df in facts.items():
        ref = gold.FACTS[name](s)
        assert df.columns == ref.columns
        assert rd(df).exceptAll(rd(ref)).count() == 0 and rd(ref).exceptAll(rd(df)).count() == 0


def test_medallion_end_to_end(spark):
    from tripflow.plans.medallion import Medallion, land_files

    root = scratch_path(spark, "medallion_test")
    land = land_files(fixtures.raw_trips(spark, SMALL).drop("source_file"), f"{root}/landing")
    m = Medallion(spark, f"{root}/tables")
    assert m.load_bronze(land, LO, HI) > 0
    assert m.load_bronze(land, LO, HI) == 0  # nothing new the second time
    m.build_silver()
    m.build_gold(fixtures.raw_zone_lookup(spark, SMALL))
    years = {r.trip_year for r in m.fact("fact_trip_yearly_summary").collect()}
    assert years and all(1996 <= y <= 2000 for y in years)
    # Platinum and model on the hourly fixture, landed the same way.
    m2 = Medallion(spark, f"{root}/hourly")
    land2 = land_files(fixtures.raw_hourly_trips(spark, SMALL), f"{root}/landing_h")
    m2.load_bronze(land2, 2024, 2024)
    m2.build_silver()
    m2.build_platinum()
    assert m2.demand_series().count() > 0
    m2.train_and_evaluate(7, model.ModelParams.leak_free(max_rounds=2, num_leaves=4))
    trained, path = m2.train_and_evaluate(7, model.ModelParams(max_rounds=3, num_leaves=8))
    m2.build_forecast(trained, path, hours=48)
    assert m2.io.read("forecast").count() == 48 * m2.demand_series().select("pu_location_id").distinct().count()


def test_read_landing_files_fast_path_for_agreeing_files(spark):
    root = scratch_path(spark, "landing_same")
    raw = fixtures.raw_trips(spark, SMALL).drop("source_file")
    raw.write.parquet(root)
    files = [r.file_name for r in landing.landed_files(spark, root).collect()]
    df = landing.read_landing_files(spark, files)
    assert df.count() == raw.count()
    assert "source_file" in df.columns and dict(df.dtypes)["tpep_pickup_datetime"] == "timestamp"


def test_leak_free_model_trains_and_forecasts(spark):
    series = model.add_lagged_averages(inputs.demand_series(spark, SMALL))
    train, test = evaluate.time_split(series, 7)
    fit, valid = model.validation_split(train, 3)
    p = model.ModelParams.leak_free(max_rounds=3, num_leaves=8)
    tm = model.train_demand_model(fit, valid, p)
    assert "avg_fare" not in model.model_features(tm.model)
    assert "avg_fare_lag_1h" in model.model_features(tm.model)
    assert valid.agg(F.min("datetime")).first()[0] > fit.agg(F.max("datetime")).first()[0]
    path = scratch_path(spark, "leak_free_model")
    model.save_model(tm, path)
    fc = forecast.forecast(tm.model, path, series, hours=24)
    assert fc.filter(F.col("trip_count") < 0).count() == 0 and fc.count() > 0
    scored = model.score(tm.model, test)
    assert scored.count() == test.count()


def test_null_zone_is_never_ranked_or_gridded(spark):
    sh = inputs.silver_hourly(spark, SMALL)
    busiest = sh.groupBy("pu_location_id").count().orderBy(F.desc("count")).first()[0]
    # Make the busiest zone NULL: it must drop out of totals and the grid.
    nulled = sh.withColumn("pu_location_id", F.when(F.col("pu_location_id") == busiest, None)
                           .otherwise(F.col("pu_location_id")))
    assert platinum.zone_totals(nulled).filter(F.col("pu_location_id").isNull()).count() == 0
    ds = platinum.demand_series(nulled)
    assert ds.filter(F.col("pu_location_id").isNull()).count() == 0 and ds.count() > 0


def test_dedup_with_a_hot_key_holding_a_third_of_rows(spark):
    typed = bronze.with_partition_year(inputs.typed_trips(spark, SMALL))
    hot = F.col("VendorID") % 3 == 0
    df = typed.withColumns({
        "VendorID": F.when(hot, F.lit(1)).otherwise(F.col("VendorID")),
        "tpep_pickup_datetime": F.when(hot, F.lit("2024-01-01 00:00:00").cast("timestamp"))
        .otherwise(F.col("tpep_pickup_datetime")),
        "tpep_dropoff_datetime": F.when(hot, F.lit("2024-01-01 00:30:00").cast("timestamp"))
        .otherwise(F.col("tpep_dropoff_datetime")),
        "source_file": F.when(hot, F.lit("hot.parquet")).otherwise(F.col("source_file")),
    })
    n_hot = df.filter(F.col("source_file") == "hot.parquet").count()
    assert n_hot > 0
    out = bronze.dedup_trips(df)
    assert out.filter(F.col("source_file") == "hot.parquet").count() == 1
    keys = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "source_file"]
    assert out.count() == df.select(*keys).distinct().count()
