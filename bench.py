"""Benchmark the headline work; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Two kinds of timings:

* ``q_*``: registered queries, fully materialised with the ``noop`` sink
  (nothing collected), median of ``BENCH_RUNS`` warm runs.
* table stages of a medallion run (land, Bronze load, Silver, six facts,
  Gold one pass, Platinum), each written as a table in the shared folder as
  a real run would; median of ``BENCH_RUNS`` runs on fresh folders. Model
  training and the 90-day forecast of every zone run once.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tripflow.operators import evaluate, gold, model  # noqa: E402
from tripflow.plans.medallion import Medallion, land_files  # noqa: E402
from tripflow.plans.queries import HOLDOUT_DAYS, REGISTRY  # noqa: E402
from tripflow.session import local_session, scratch_path  # noqa: E402
from tripflow.sources import fixtures  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
QUERIES = (
    "silver_trips", "fact_trip_yearly_summary", "fact_trip_time_summary", "dedup_trips",
    "demand_series", "payment_mix", "top_zones_by_revenue", "hour_profile", "zone_metrics",
    "row_counts",
)


def materialise(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def clock(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def split_tables(spark, sf: str, files: int) -> str:
    """A copy of the tables that the queries read, in ``files`` files each: the
    given ones are a single row group, which one core would read."""
    root = scratch_path(spark, "bench_tables")
    for name in ("lineitem", "events", "customer", "nation", "region"):
        df = spark.read.parquet(f"{sf}/{name}.parquet")
        df.repartition(files if name in ("lineitem", "events") else 1).write.parquet(f"{root}/{name}.parquet")
    return root


def median(xs) -> float:
    return round(statistics.median(xs), 3)


def medallion_run(spark, sf: str) -> dict:
    """One trip-side run from landed files to Gold tables."""
    root = scratch_path(spark, "bench_medallion")
    t = {}
    t["land_trips"] = clock(lambda: land_files(
        fixtures.raw_trips(spark, sf).drop("source_file"), f"{root}/landing"))
    m = Medallion(spark, f"{root}/tables")
    lo, hi = fixtures.TRIPS_VALID_YEARS
    t["bronze_load_split_dedup"] = clock(lambda: m.load_bronze(f"{root}/landing", lo, hi))
    t["silver_table"] = clock(m.build_silver)

    def six_facts():
        for fn in gold.FACTS.values():
            materialise(fn(m.silver()))

    t["six_facts_from_silver"] = clock(six_facts)
    t["gold_one_pass_tables"] = clock(lambda: m.build_gold(fixtures.raw_zone_lookup(spark, sf)))
    return t


def main() -> None:
    spark = local_session(cores=CPUS, shuffle_partitions=int(CPUS) * 2, app="tripflow-bench")
    sf = split_tables(spark, SF_DIR, int(CPUS))
    out: dict[str, float] = {}

    # Warm-up: JVM, codegen caches, file listing.
    materialise(REGISTRY["fact_trip_yearly_summary"](spark, sf))

    for name in QUERIES:
        out[f"q_{name}"] = median([clock(lambda n=name: materialise(REGISTRY[n](spark, sf)))
                                   for _ in range(RUNS)])

    runs = [medallion_run(spark, sf) for _ in range(RUNS)]
    for k in runs[0]:
        out[k] = median([r[k] for r in runs])

    # Hourly side: landed H -> Bronze -> Silver -> Platinum, then the model.
    root = scratch_path(spark, "bench_hourly")
    land_files(fixtures.raw_hourly_trips(spark, sf), f"{root}/landing")
    m = Medallion(spark, f"{root}/tables")
    m.load_bronze(f"{root}/landing", 1900, 2100)
    m.build_silver()
    out["platinum_demand_series_table"] = round(clock(m.build_platinum), 3)

    t0 = time.perf_counter()
    trained, path = m.train_and_evaluate(HOLDOUT_DAYS)
    out["model_training_and_evaluation"] = round(time.perf_counter() - t0, 3)
    out["forecast_2160h_all_zones"] = round(clock(lambda: m.build_forecast(trained, path)), 3)

    series = m.demand_series()
    _, test = evaluate.time_split(series, HOLDOUT_DAYS)
    preds = m.io.read("model_evaluation/demand_predictions")
    m_model = evaluate.forecast_metrics(preds).first()
    m_naive = evaluate.forecast_metrics(evaluate.prediction_frame(evaluate.seasonal_naive(test))).first()
    n_fc = m.io.read("forecast").count()

    # Leak-free variant: previous-hour averages, validation carved from train.
    lf_series = model.add_lagged_averages(series)
    lf_train, lf_test = evaluate.time_split(lf_series, HOLDOUT_DAYS)
    lf_fit, lf_valid = model.validation_split(lf_train, 3)
    t0 = time.perf_counter()
    lf = model.train_demand_model(lf_fit, lf_valid, model.ModelParams.leak_free())
    lf_sec = round(time.perf_counter() - t0, 3)
    m_lf = evaluate.forecast_metrics(evaluate.prediction_frame(model.score(lf.model, lf_test))).first()

    match = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "sf": float(match.group(1)) if match else SF_DIR,
        "cpus": int(CPUS),
        "runs": RUNS,
        "model": {
            "best_iteration": trained.best_iteration,
            "mae": round(m_model["mae"], 4),
            "rmse": round(m_model["rmse"], 4),
            "naive_mae": round(m_naive["mae"], 4),
            "naive_rmse": round(m_naive["rmse"], 4),
            "forecast_rows": n_fc,
            "leak_free_mae": round(m_lf["mae"], 4),
            "leak_free_rmse": round(m_lf["rmse"], 4),
            "leak_free_best_iteration": lf.best_iteration,
            "leak_free_training_sec": lf_sec,
        },
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
