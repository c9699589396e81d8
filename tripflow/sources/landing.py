"""Landed trip files: dataset and per-file reads, file listing, progress.

Monthly files drift in schema (a column spelled ``Airport_fee``, a count
stored as DOUBLE). One read over mixed physical types fails, so
``read_landing_files`` reads each *schema group* once and aligns the groups
by name. Loads hand it bounded lists of files. New files are found by listing
only the folders that changed since they were last listed.
"""

from __future__ import annotations

import re
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripflow.operators.bronze import TRIP_SCHEMA, enforce_schema
from tripflow.sources.storage import Storage

# Landed file naming (``year=YYYY/yellow_tripdata_YYYY-MM.parquet``).
LANDED_NAME = r"^yellow_tripdata_(.*)\.parquet$"
LANDED_MONTH_FORMAT = "yyyy-M"


def _with_source(df: DataFrame) -> DataFrame:
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def read_landing(spark: SparkSession, path: str, schema: StructType | None = TRIP_SCHEMA) -> DataFrame:
    """Every landed file as one dataset, with the file each row came from.

    Read with the declared schema, whatever the number of files: no footer is
    opened before the scan, a column that a file lacks is NULL. Without a schema
    those of all files are merged, which opens every footer. Files whose types
    conflict are for ``read_landing_files``."""
    reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
    return _with_source(reader.parquet(path))


#: Files whose footers one task reads.
FILES_A_TASK = 32
_FOOTERS = "file_name STRING, footer STRING, error STRING"


def _footers(batches):
    """Each file's physical schema, with what its writer noted, or the error.
    ``error`` is empty where this worker knows no such storage."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs

    for batch in batches:
        names, footers, errors = batch.column(0).to_pylist(), [], []
        for name in names:
            footer = error = None
            try:
                store, path = fs.FileSystem.from_uri(re.sub(r"^s3an?:", "s3:", name))
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
                error = ""
            else:
                try:
                    about = pq.read_metadata(path, filesystem=store)
                    footer = f"{about.schema}{(about.metadata or {}).get(b'org.apache.spark.sql.parquet.row.metadata', b'')!r}"
                    footer = footer[footer.index("\n"):]  # the first line has an address
                except (pa.ArrowException, OSError) as e:
                    error = f"{type(e).__name__}: {e}"[:500]
            footers.append(footer)
            errors.append(error)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (names, footers, errors)], names=["file_name", "footer", "error"])


def _own_schema(spark: SparkSession, path: str):
    try:
        return spark.read.parquet(path).schema, None
    except (PySparkException, Py4JJavaError) as e:
        return None, (str(e).strip().splitlines() or [type(e).__name__])[0][:500]


def read_schemas(spark: SparkSession, paths: list[str]) -> tuple[dict, dict[str, str]]:
    """Each file's schema from its footer, and the files without one, with the
    error. Footers are read by the executors; the driver asks Spark for one file of
    each distinct footer (and for files in a store that only Spark reads)."""
    names = spark.createDataFrame([(p,) for p in paths], "file_name STRING")
    read = names.repartition(max(1, -(-len(paths) // FILES_A_TASK))).mapInArrow(_footers, _FOOTERS).collect()
    schemas, failed, of = {}, {}, {}
    for r in read:
        key = r.footer if r.footer is not None else r.file_name
        if r.error:
            failed[r.file_name] = r.error
            continue
        if key not in of:
            of[key] = _own_schema(spark, r.file_name)
        schema, error = of[key]
        if schema is None:
            failed[r.file_name] = error
        else:
            schemas[r.file_name] = schema
    return schemas, failed


def read_landing_files(spark: SparkSession, paths, schemas: dict | None = None) -> DataFrame:
    """Read files whose schemas may conflict.

    Files are grouped by their own schema; each group is one scan with that
    schema, normalised and typed to the declared one, and the groups are
    aligned by column name. A scan takes as many files as there are cores, so that
    Spark packs no more than about one file into a task, however many there are.
    A file without a readable footer raises ``ValueError``; ``read_schemas`` tells
    beforehand.
    """
    paths = list(paths)
    if not paths:
        raise ValueError("no files to read")
    if schemas is None:
        schemas, bad = read_schemas(spark, paths)
        if bad:
            raise ValueError(f"unreadable files: {bad}")
    groups: dict[str, list[str]] = {}
    for p in paths:
        groups.setdefault(schemas[p].json(), []).append(p)
    most = spark.sparkContext.defaultParallelism
    scans = [ps[k: k + most] for ps in groups.values() for k in range(0, len(ps), most)]
    parts = [enforce_schema(_with_source(spark.read.schema(schemas[ps[0]]).parquet(*ps))) for ps in scans]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def landed_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """File names under ``path`` (recursive). Only the ``path`` column of the
    binary-file source is selected, so file contents are never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
        .select(F.col("path").alias("file_name"))
    )


def changed_files(spark: SparkSession, path: str, marks: dict[str, int]) -> tuple[list[str], dict[str, int], int]:
    """Parquet files of the folders that changed since ``marks``, the new
    marks, and how many folders were listed. A landing area grows by files and
    folders; folders that nothing came to cost one look at their time."""
    files, marks, listed = Storage(spark).changed(path, marks)
    return [f for f in files if f.endswith(".parquet")], marks, listed


def new_files(landed: DataFrame, ledger: DataFrame, col: str = "file_name") -> DataFrame:
    """Landed files not yet in the ledger."""
    return landed.join(ledger.select(col), on=col, how="left_anti")


def landing_progress(files: DataFrame, start: str, col: str = "file_name") -> DataFrame:
    """Latest month present among well-formed file names, and the next
    month to load (``start`` when there is none). Malformed names are
    skipped. One row."""
    base = F.regexp_extract(F.col(col), r"[^/]*$", 0)
    part = F.regexp_extract(base, LANDED_NAME, 1)
    month = F.to_date(F.try_to_timestamp(F.nullif(part, F.lit("")), F.lit(LANDED_MONTH_FORMAT)))
    latest = files.agg(F.max(month).alias("latest_month"))
    nxt = F.coalesce(F.add_months("latest_month", 1), F.to_date(F.lit(start)))
    return latest.select(
        "latest_month",
        nxt.alias("next_month"),
        F.date_format("latest_month", "yyyy-MM").alias("latest_label"),
        F.date_format(nxt, "yyyy-MM").alias("next_label"),
    )
