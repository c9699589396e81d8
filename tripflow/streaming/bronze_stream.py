"""Incremental Bronze load as a Structured Streaming job.

The landing folder is a file stream of *paths* (binary-file source, contents
never read): the stream's checkpoint remembers which files were seen, which
replaces a hand-kept "already processed" set. Each micro-batch loads its new
files as a batch load does (``sources.loading``): good rows, quarantine and
files that can't be read each go to the batch's own partitions, the ledger
last. If an executor or the driver dies mid-batch, the replay of that batch id
replaces whatever the failed attempt left, instead of appending twice. A batch is
named by the stream's own id, kept in its checkpoint, and its number, so other streams
and batch loads on the same tables stay apart; a stream started anew has a new id,
sees all files again, and loads those that nobody has committed.

The stream sees a file once. Those that failed are planned as batch loads when
the stream is next started.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    BinaryType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tripflow.session import ensure_conf
from tripflow.sources.loading import create_tables, load_files, retry_failed
from tripflow.sources.storage import Storage
from tripflow.sources.tables import TableIO

BINARY_FILE_SCHEMA = StructType(
    [
        StructField("path", StringType(), False),
        StructField("modificationTime", TimestampType(), False),
        StructField("length", LongType(), False),
        StructField("content", BinaryType(), True),
    ]
)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table written by the stream, with every column its files brought."""
    root, _, name = path.rstrip("/").rpartition("/")
    return TableIO(spark, root).read(name)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint."""
    return json.loads(Storage(spark).read_text(f"{checkpoint.rstrip('/')}/metadata"))["id"]


def load_name(stream: str, batch_id: int) -> str:
    return f"stream-{stream}-{batch_id:08d}"


def bronze_batch(spark: SparkSession, root: str, lo: int, hi: int, checkpoint: str):
    """The ``foreachBatch`` body of the stream with this checkpoint."""

    def run(batch: DataFrame, batch_id: int) -> None:
        # The batch is a list of new file paths (bounded by maxFilesPerTrigger).
        paths = [r.path for r in batch.select("path").collect()]
        if paths:
            load_files(TableIO(batch.sparkSession, root), paths, load_name(stream_id(spark, checkpoint), batch_id), lo, hi)

    return run


def stream_bronze(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    lo: int,
    hi: int,
    max_files_per_trigger: int = 64,
) -> dict:
    """Load every landed file not seen before, then stop
    (``availableNow``). Files that failed before are tried again first. Returns
    the table paths."""
    ensure_conf(spark)
    io = TableIO(spark, root)
    create_tables(io)
    retry_failed(io, lo, hi, max_files_per_trigger)
    tables = {
        "bronze": io.path("bronze"),
        "quarantine": io.path("quarantine"),
        "failed": io.path("_failed_files"),
        "ledger": io.path("_processed_files"),
    }
    paths = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(landing)
        .select("path")
    )
    q = (
        paths.writeStream.foreachBatch(
            bronze_batch(spark, root, lo, hi, checkpoint)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return tables
