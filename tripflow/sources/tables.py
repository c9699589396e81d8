"""Table sinks and sources by path, and the processed-file ledger.

Parquet directories stand in for the managed tables (no transactional format is
installed). A table's schema is kept beside the tables and grows with columns
that later writes bring, so a read needs no footers and an empty table has its
columns. Each change of a schema is a new small file, renamed into place by the
storage layer without a Spark job: a reader or a crash in between finds the one
before. A full overwrite replaces a table; an overwrite of partitions replaces
only those that the new rows have.

Partitioned writes cluster rows by the partition column with the ``REBALANCE``
hint rather than ``repartition(n, col)``: a hash repartition by year sends a
whole year (possibly a third of the data) to one task, while a rebalance lets
adaptive execution split oversized partitions and merge small ones at run time,
so output files stay even.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from tripflow.sources.storage import Storage

LEDGER_SCHEMA = StructType(
    [
        StructField("file_name", StringType(), True),
        StructField("processed_time", TimestampType(), True),
        StructField("load_id", StringType(), True),
    ]
)


class TableIO:
    """Tables as Parquet directories under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.storage = Storage(spark)
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # ------------------------------------------------------------ schemas
    def _schema_folder(self, name: str) -> str:
        return f"{self.root}/_schemas/{name}"

    def _schema(self, name: str) -> tuple[int, StructType | None]:
        """The number of the last schema file (0: none) and what it says."""
        files = [n for n in self.storage.names(self._schema_folder(name)) if n.endswith(".json")]
        if not files:
            return 0, None
        return int(files[-1][1:-5]), StructType.fromJson(json.loads(self.storage.read_text(f"{self._schema_folder(name)}/{files[-1]}")))

    def schema(self, name: str) -> StructType | None:
        """The declared schema, or None of a table that nobody wrote."""
        return self._schema(name)[1]

    def declare(self, name: str, schema: StructType, replace: bool = False) -> None:
        """Record the columns of a table; new ones join those it has. Runs
        before the data are written: a column without data reads as NULL."""
        version, known = self._schema(name)
        fields = list(known.fields) if known and not replace else []
        there = {f.name for f in fields}
        fields += [StructField(f.name, f.dataType, True) for f in schema.fields if f.name not in there]
        if known is None or fields != known.fields:
            self.storage.write_text(f"{self._schema_folder(name)}/v{version + 1:08d}.json", json.dumps(StructType(fields).jsonValue()))

    def create(self, name: str, schema: StructType) -> None:
        """An empty table, if there is none."""
        if self.schema(name) is None:
            self.declare(name, schema)
            self.spark.createDataFrame([], schema).write.mode("append").parquet(self.path(name))

    def read(self, name: str) -> DataFrame:
        """S3: the table with every column it was ever written with."""
        schema = self.schema(name)
        if schema is None:
            raise FileNotFoundError(f"no table {name} under {self.root}")
        return self.spark.read.schema(schema).parquet(self.path(name))

    # ------------------------------------------------------------ writes
    def append(self, df: DataFrame, name: str, partition_by=None) -> str:
        """Append, optionally partitioned (NULL partition values land
        in the default partition)."""
        self.declare(name, df.schema)
        w = _cluster(df, partition_by).write.mode("append")
        if partition_by:
            w = w.partitionBy(*_as_list(partition_by))
        w.parquet(self.path(name))
        return self.path(name)

    def overwrite(self, df: DataFrame, name: str, partition_by=None, only_partitions: bool = False, observe=None) -> str:
        """Replace the table, or (``only_partitions``) just the partitions
        that ``df`` has rows for. ``observe``: an Observation that gets ``n``, the
        rows written, counted by the writing tasks themselves (tasks before the
        last shuffle may run twice)."""
        self.declare(name, df.schema, replace=not only_partitions)
        rows = _cluster(df, partition_by)
        w = (rows if observe is None else rows.observe(observe, F.count(F.lit(1)).alias("n"))).write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*_as_list(partition_by))
        w.option("partitionOverwriteMode", "dynamic" if only_partitions else "static").parquet(self.path(name))
        return self.path(name)

    def write_dim(self, df: DataFrame, name: str) -> str:
        """A small dimension as one file."""
        return self.overwrite(df.repartition(1), f"dimensions/{name}")

    def write_fact(self, df: DataFrame, name: str) -> str:
        """A fact as one file. ``repartition(1)`` adds a cheap final
        exchange of the (small) aggregate, where ``coalesce(1)`` would pull the
        aggregation itself into a single task."""
        return self.overwrite(df.repartition(1), f"facts/{name}")

    def write_features(self, df: DataFrame, name: str) -> str:
        """The feature store, clustered by zone into even files."""
        return self.overwrite(df.hint("rebalance", "pu_location_id"), name)

    def write_evaluation(self, preds: DataFrame, metrics: DataFrame, importances: DataFrame) -> dict:
        """Prediction, per-zone metric and importance tables."""
        return {
            "demand_predictions": self.overwrite(preds, "model_evaluation/demand_predictions"),
            "forecast_metrics": self.write_fact_like(metrics, "model_evaluation/forecast_metrics"),
            "forecast_feature_importance": self.write_fact_like(
                importances, "model_evaluation/forecast_feature_importance"
            ),
        }

    def write_fact_like(self, df: DataFrame, name: str) -> str:
        return self.overwrite(df.repartition(1), name)


class FileLedger:
    """Which landed files were loaded, when, and by which load.

    A load's rows are one partition, so recording it again changes nothing but
    the time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        root, _, self.name = path.rstrip("/").rpartition("/")
        self.io = TableIO(spark, root)

    def init(self) -> "FileLedger":
        """Create the empty ledger if it does not exist yet."""
        self.io.create(self.name, LEDGER_SCHEMA)
        return self

    def read(self) -> DataFrame:
        return self.io.read(self.name)

    def append(self, files: DataFrame, col: str = "file_name", load_id: str = "0") -> None:
        """Record ``files`` (a DataFrame of names) as processed now by a load."""
        rows = files.select(F.col(col).alias("file_name"), F.current_timestamp().alias("processed_time"), F.lit(str(load_id)).alias("load_id"))
        self.io.overwrite(rows, self.name, partition_by="load_id", only_partitions=True)

    def latest(self) -> DataFrame:
        """The last processing time (one row; NULL when empty)."""
        return self.read().agg(F.max("processed_time").alias("latest_processed_time"))


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def _cluster(df: DataFrame, partition_by) -> DataFrame:
    """Rows of one output partition together, skew split at run time."""
    return df.hint("rebalance", *_as_list(partition_by)) if partition_by else df
