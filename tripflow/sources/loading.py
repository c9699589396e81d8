"""Loads of landed files into Bronze, each safe to repeat.

A load is named by where it comes from and a number of that source's own
(``batch-...``, ``stream-<query>-<batch>``), so batch loads, streams and streams
started anew never share a name. Its good rows, its quarantine, the files it could
not read, its counts and its ledger rows are partitions of that name, written in that
order and each replaced when the load is run again: a load that failed anywhere
leaves nothing twice, and no load touches another's rows. The ledger row is the
commit; a file that any load has committed is not loaded by another.

Batch loads are planned before they run: the files that are new, and those that
failed before, are dealt to loads of bounded size and written down, and only then do
the landing folders keep the time at which they were listed. A retry loads what was
planned, whatever has landed since.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from tripflow.operators.bronze import TRIP_SCHEMA, bronze_transform
from tripflow.sources import landing
from tripflow.sources.tables import FileLedger, TableIO

LOAD_ID = StructField("load_id", StringType(), True)
BRONZE_SCHEMA = StructType(
    [*TRIP_SCHEMA.fields, StructField("bronze_ingestion_time", TimestampType(), True), StructField("source_file", StringType(), True), LOAD_ID]
)
FAILED_SCHEMA = StructType([StructField("file_name", StringType(), True), StructField("error", StringType(), True), LOAD_ID])
PLAN_SCHEMA = StructType([StructField("file_name", StringType(), True), LOAD_ID])
#: Rows that each table got from a load.
COUNTS_SCHEMA = StructType([StructField("stage", StringType(), True), StructField("row_count", LongType(), True), LOAD_ID])
FOLDERS_SCHEMA = StructType([StructField("folder", StringType(), True), StructField("modified", LongType(), True), StructField("landing", StringType(), True)])


def create_tables(io: TableIO) -> FileLedger:
    for name, schema in (
        ("bronze", BRONZE_SCHEMA), ("quarantine", BRONZE_SCHEMA), ("_failed_files", FAILED_SCHEMA), ("_planned_files", PLAN_SCHEMA),
        ("_row_counts", COUNTS_SCHEMA), ("_landing_folders", FOLDERS_SCHEMA),
    ):
        io.create(name, schema)
    return ledger_of(io).init()


def ledger_of(io: TableIO) -> FileLedger:
    return FileLedger(io.spark, io.path("_processed_files"))


def _tag(df: DataFrame, load_id: str) -> DataFrame:
    return df.withColumn("load_id", F.lit(load_id))


def committed_loads(io: TableIO) -> DataFrame:
    """Names of the loads that the ledger has."""
    return ledger_of(io).read().select("load_id").distinct()


def committed(io: TableIO, name: str) -> DataFrame:
    """Rows of ``bronze`` or ``quarantine`` whose load is committed."""
    return io.read(name).join(committed_loads(io), "load_id", "left_semi")


def row_counts(io: TableIO) -> DataFrame:
    """A1: rows that each table got, over all committed loads, as observed while
    they were written: no table is read again. Layers that are rebuilt whole are
    counted under a name of their own."""
    counts = io.read("_row_counts")
    kept = counts.join(committed_loads(io), "load_id", "left_semi").union(counts.where(F.col("load_id").startswith("layer-")).select("load_id", "stage", "row_count"))
    return kept.groupBy("stage").agg(F.sum("row_count").alias("row_count"))


def record_counts(io: TableIO, load_id: str, counts: dict[str, int]) -> None:
    rows = io.spark.createDataFrame([(k, int(v), load_id) for k, v in counts.items()], COUNTS_SCHEMA)
    io.overwrite(rows, "_row_counts", "load_id", only_partitions=True)


def write_observed(io: TableIO, df: DataFrame, name: str, **how) -> int:
    """``overwrite`` and the number of rows that passed."""
    seen = Observation()
    io.overwrite(df, name, observe=seen, **how)
    return seen.get.get("n", 0)


def _write_rows(io: TableIO, paths: list[str], schemas: dict, load_id: str, lo: int, hi: int) -> dict[str, int]:
    good, bad = bronze_transform(landing.read_landing_files(io.spark, paths, schemas), lo, hi)
    how = {"partition_by": ["load_id", "year"], "only_partitions": True}
    return {"bronze": write_observed(io, _tag(good, load_id), "bronze", **how), "quarantine": write_observed(io, _tag(bad, load_id), "quarantine", **how)}


def named_in(error: Exception, paths: list[str]) -> list[str]:
    """Those of the files that an error's text names."""
    text = str(error)
    base = {p: re.sub(r"^\w+:/+", "/", p) for p in paths}
    return [p for p in paths if p in text or base[p] in text]


def load_files(io: TableIO, paths: list[str], load_id: str, lo: int, hi: int) -> dict[str, str]:
    """Load a bounded list of files. A file that can't be read is set aside with
    its error and left out of the ledger, so the next run tries it again; the others
    load. Files that another load has committed are left out. Returns the files set
    aside."""
    asked = io.spark.createDataFrame([(p,) for p in sorted(set(paths))], "file_name STRING")
    others = ledger_of(io).read().where(F.col("load_id") != load_id)
    paths = sorted(r[0] for r in asked.join(others, "file_name", "left_anti").collect())
    schemas, failed = landing.read_schemas(io.spark, paths) if paths else ({}, {})
    readable, counts = [p for p in paths if p in schemas], {}
    while readable:
        try:
            counts = _write_rows(io, readable, schemas, load_id, lo, hi)
            break
        except (PySparkException, Py4JJavaError) as e:
            # Footers were fine; the error names the file whose rows are not.
            broken = named_in(e, readable)
            if not broken:
                raise
            failed |= {p: (str(e).strip().splitlines() or [""])[0][:500] for p in broken}
            readable = [p for p in readable if p not in broken]
    if failed:
        rows = io.spark.createDataFrame(sorted(failed.items()), "file_name STRING, error STRING")
        io.overwrite(_tag(rows, load_id), "_failed_files", "load_id", only_partitions=True)
    if readable:
        record_counts(io, load_id, counts)
        ledger_of(io).append(io.spark.createDataFrame([(p,) for p in readable], "file_name STRING"), load_id=load_id)
    return failed


# ------------------------------------------------------------------ planning


def open_loads(io: TableIO) -> list[str]:
    """Planned loads with files that neither loaded nor failed under them."""
    settled = ledger_of(io).read().select("file_name", "load_id").union(io.read("_failed_files").select("file_name", "load_id"))
    elsewhere = ledger_of(io).read().select("file_name")
    left = io.read("_planned_files").join(settled, ["file_name", "load_id"], "left_anti").join(elsewhere, "file_name", "left_anti")
    return sorted(r[0] for r in left.select("load_id").distinct().collect())


def planned_files(io: TableIO, load_id: str) -> list[str]:
    return sorted(r[0] for r in io.read("_planned_files").where(F.col("load_id") == load_id).select("file_name").collect())


def plan(io: TableIO, files: DataFrame, most_files: int) -> None:
    """Deals ``files`` (file_name) that aren't in the ledger to loads of about
    ``most_files``, together with files that failed and have not loaded since."""
    ledger = ledger_of(io).read().select("file_name")
    waiting = files.select("file_name").union(io.read("_failed_files").select("file_name")).distinct().join(ledger, "file_name", "left_anti").persist()
    try:
        loads = -(-waiting.count() // most_files)
        if loads:
            # Runs in order of time; the tail keeps two runs apart.
            run = F.date_format(F.current_timestamp(), "yyyyMMddHHmmssSSS")
            name = F.concat(F.lit("batch-"), run, F.lit(f"-{uuid.uuid4().hex[:6]}-"), F.lpad(F.pmod(F.xxhash64("file_name"), F.lit(loads)).cast("string"), 6, "0"))
            io.overwrite(waiting.select("file_name", name.alias("load_id")), "_planned_files", "load_id", only_partitions=True)
    finally:
        waiting.unpersist()


def plan_landing(io: TableIO, path: str, most_files: int) -> int:
    """Plans what is new below a landing folder; the number of folders listed."""
    own = io.read("_landing_folders").where(F.col("landing") == path)
    marks = {r.folder: r.modified for r in own.collect()}
    found, new_marks, listed = landing.changed_files(io.spark, path, marks)
    plan(io, io.spark.createDataFrame([(f,) for f in found], "file_name STRING"), most_files)
    # Only now: a crash before makes the next run list these folders again.
    if new_marks != marks:
        rows = io.spark.createDataFrame([(f, t, path) for f, t in new_marks.items()], FOLDERS_SCHEMA)
        io.overwrite(rows, "_landing_folders", "landing", only_partitions=True)
    return listed


def run_loads(io: TableIO, loads: list[str], lo: int, hi: int) -> int:
    """Runs planned loads; the number of files that loaded."""
    done = 0
    for load_id in loads:
        files = planned_files(io, load_id)
        done += len(files) - len(load_files(io, files, load_id, lo, hi))
    return done


def retry_failed(io: TableIO, lo: int, hi: int, most_files: int) -> int:
    """Files that failed and have not loaded since, tried once more."""
    before = set(open_loads(io))
    plan(io, io.spark.createDataFrame([], "file_name STRING"), most_files)
    return run_loads(io, [x for x in open_loads(io) if x not in before], lo, hi)
