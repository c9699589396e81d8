"""End-to-end batch run: landed files -> Bronze -> Silver -> Gold -> Platinum
-> model, evaluation and forecast tables.

Every layer is written as a table before the next one reads it. That is the
lineage cut: if executors are lost later, Spark recomputes from the last
written table, never from the raw files. All tables live under one root,
which on a cluster is shared storage (by default a folder under
``spark.checkpoint.dir``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators import evaluate, forecast, gold, model, platinum, silver
from tripflow.operators.bronze import DEDUP_KEYS
from tripflow.plans.live import Live
from tripflow.session import ensure_conf
from tripflow.sources.loading import committed, create_tables, open_loads, plan_landing, run_loads
from tripflow.sources.tables import TableIO


@dataclass
class Medallion:
    spark: SparkSession
    root: str

    def __post_init__(self):
        ensure_conf(self.spark)
        self.io = TableIO(self.spark, self.root)
        self.ledger = create_tables(self.io)
        self.live = Live(self.io)

    # ------------------------------------------------------------ Bronze
    def load_bronze(self, landing_path: str, lo: int, hi: int, files_a_load: int = 256) -> int:
        """Load landed files not yet in the ledger (S15) in loads of bounded
        size: schema-group read (S2), split and dedup, Bronze, quarantine,
        files that failed, then the ledger. Loads that were cut off are run
        again first; files that failed in earlier runs are tried once more.
        Returns the number of files loaded."""
        done = run_loads(self.io, open_loads(self.io), lo, hi)
        plan_landing(self.io, landing_path, files_a_load)
        return done + run_loads(self.io, open_loads(self.io), lo, hi)

    # ------------------------------------------------------------ Silver
    def build_silver(self) -> str:
        """The whole table anew: years without rows any more go."""
        trips = silver.silver_transform(committed(self.io, "bronze").drop("load_id"))
        return self.io.overwrite(trips, "silver", partition_by="trip_year")

    def silver(self) -> DataFrame:
        return self.io.read("silver")

    # ------------------------------------------------------------ Gold
    def build_gold(self, zone_lookup: DataFrame) -> dict:
        """Dimensions, then the six facts from one grouping-sets pass over
        Silver. The combined aggregate is written once, then split."""
        self.io.write_dim(gold.dim_vendor(self.spark), "dim_vendor")
        self.io.write_dim(gold.dim_rate_code(self.spark), "dim_rate_code")
        self.io.write_dim(gold.dim_payment_type(self.spark), "dim_payment_type")
        self.io.write_dim(gold.dim_store_forward_flag(self.spark), "dim_store_forward_flag")
        self.io.write_dim(gold.dim_location(zone_lookup), "dim_location")
        self.io.overwrite(gold.fact_grouping_sets(self.silver()), "_fact_grouping_sets")
        facts = gold.split_facts(self.io.read("_fact_grouping_sets"))
        return {name: self.io.write_fact(df, name) for name, df in facts.items()}

    def fact(self, name: str) -> DataFrame:
        return self.io.read(f"facts/{name}")

    # ------------------------------------------------------------ Platinum
    def build_platinum(self) -> str:
        return self.io.write_features(platinum.demand_series(self.silver()), "demand_series")

    def demand_series(self) -> DataFrame:
        return self.io.read("demand_series")

    # ------------------------------------------------------------ model
    def train_and_evaluate(self, holdout_days: int = 30, params: model.ModelParams | None = None):
        """M1-M5 and S12. With leak-free features the rounds are chosen on the
        last days of the training rows, never on the test set."""
        series = self.demand_series()
        if params is not None and set(model.LEAK_FREE_FEATURES) <= set(params.features):
            train, test = evaluate.time_split(model.add_lagged_averages(series), holdout_days)
            fit, valid = model.validation_split(train, max(1, holdout_days // 2))
        else:
            train, test = evaluate.time_split(series, holdout_days)
            fit, valid = train, test
        trained = model.train_demand_model(fit, valid, params)
        path = model.save_model(trained, self.io.path("model"))
        preds = evaluate.prediction_frame(model.score(trained.model, test))
        self.io.write_evaluation(
            preds, evaluate.zone_metrics(preds), model.feature_importance(trained, self.spark)
        )
        return trained, path

    def build_forecast(self, trained: model.TrainedModel, path: str, hours: int = forecast.HORIZON_HOURS) -> str:
        fc = forecast.forecast(trained.model, path, self.demand_series(), hours=hours)
        return self.io.overwrite(fc, "forecast")


#: Rows that one task writes as landed files.
ROWS_A_TASK = 1 << 20


def land_files(df: DataFrame, path: str, files: int = 8, year_col: str = "tpep_dropoff_datetime") -> str:
    """Write trip rows as landed files, one folder per year; copies of a trip
    land in one file. The number of tasks (``files`` at least) grows with the rows,
    and each takes a range of times, so it writes few folders."""
    tasks = max(files, -(-df.count() // ROWS_A_TASK))
    dealt = df.repartitionByRange(tasks, year_col, *(k for k in DEDUP_KEYS if k != year_col))
    dealt.withColumn("year", F.year(year_col)).write.partitionBy("year").parquet(path)
    return path
