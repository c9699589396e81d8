"""Bronze: schema enforcement, ingestion metadata, validity split, dedup.

Every function maps DataFrame -> DataFrame and stays lazy; Catalyst collapses
the projections into one and pushes the split predicates into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# The declared trip-file schema. ``cbd_congestion_fee`` is an
# evolved column that later stages need, so it is declared here as well.
TRIP_SCHEMA_DDL = """
    VendorID BIGINT,
    tpep_pickup_datetime TIMESTAMP,
    tpep_dropoff_datetime TIMESTAMP,
    passenger_count BIGINT,
    trip_distance DOUBLE,
    RatecodeID BIGINT,
    store_and_fwd_flag STRING,
    PULocationID BIGINT,
    DOLocationID BIGINT,
    payment_type BIGINT,
    fare_amount DOUBLE,
    extra DOUBLE,
    mta_tax DOUBLE,
    tip_amount DOUBLE,
    tolls_amount DOUBLE,
    improvement_surcharge DOUBLE,
    total_amount DOUBLE,
    congestion_surcharge DOUBLE,
    airport_fee DOUBLE,
    year INT,
    cbd_congestion_fee DOUBLE
"""
_DDL_TYPES = {
    "BIGINT": LongType(),
    "INT": IntegerType(),
    "DOUBLE": DoubleType(),
    "STRING": StringType(),
    "TIMESTAMP": TimestampType(),
}


def schema_from_ddl(ddl: str) -> StructType:
    """Flat ``name TYPE, ...`` DDL to a StructType (no session needed)."""
    fields = []
    for part in ddl.split(","):
        name, typ = part.split()
        fields.append(StructField(name, _DDL_TYPES[typ.upper()], True))
    return StructType(fields)


TRIP_SCHEMA = schema_from_ddl(TRIP_SCHEMA_DDL)

DEDUP_KEYS = ("VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime")


def normalise_columns(df: DataFrame, schema: StructType = TRIP_SCHEMA) -> DataFrame:
    """Rename columns that match a declared name case-insensitively
    (``Airport_fee`` -> ``airport_fee``). Runs before the casts so drifted
    spellings are typed too."""
    declared = {f.name.lower(): f.name for f in schema.fields}
    renames = {
        c: declared[c.lower()]
        for c in df.columns
        if c.lower() in declared and c != declared[c.lower()]
    }
    return df.withColumnsRenamed(renames) if renames else df


def enforce_schema(
    df: DataFrame, schema: StructType = TRIP_SCHEMA, add_missing: bool = True
) -> DataFrame:
    """Cast every declared column to its type in one projection.

    ``try_cast`` turns unparsable values into NULL instead of failing the job
    (ANSI mode). Declared columns that are absent become typed NULLs when
    ``add_missing``; undeclared columns pass through unchanged, after the
    declared ones.
    """
    df = normalise_columns(df, schema)
    present = set(df.columns)
    cols: list[Column] = []
    for field in schema.fields:
        if field.name in present:
            c = F.col(field.name)
            if df.schema[field.name].dataType != field.dataType:
                c = c.try_cast(field.dataType)
            cols.append(c.alias(field.name))
        elif add_missing:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    declared = {f.name for f in schema.fields}
    cols.extend(F.col(c) for c in df.columns if c not in declared)
    return df.select(*cols)


def add_ingest_metadata(df: DataFrame) -> DataFrame:
    """Load time, and the source file when the reader has not attached it.

    ``read_landing`` attaches ``source_file`` from the scan's hidden
    ``_metadata.file_path`` (which only a direct file scan exposes).
    """
    cols = {"bronze_ingestion_time": F.current_timestamp()}
    if "source_file" not in df.columns:
        cols["source_file"] = F.col("_metadata.file_path")
    return df.withColumns(cols)


def with_partition_year(df: DataFrame, col: str = "tpep_dropoff_datetime") -> DataFrame:
    """Partition year from the dropoff time, replacing any incoming ``year``."""
    return df.withColumn("year", F.year(col))


def valid_year(col: str, lo: int, hi: int) -> Column:
    """True for lo <= year <= hi, and False (never NULL) otherwise, so the
    good and bad sides are exact complements."""
    return F.coalesce(F.col(col).between(lo, hi), F.lit(False))


def split_valid(
    df: DataFrame, lo: int, hi: int, col: str = "year"
) -> tuple[DataFrame, DataFrame]:
    pred = valid_year(col, lo, hi)
    return df.filter(pred), df.filter(~pred)


def dedup_trips(
    df: DataFrame,
    keys: tuple[str, ...] = DEDUP_KEYS,
    within: str | None = "source_file",
) -> DataFrame:
    """Keep one row per key (within one source file), deterministically.

    The survivor is the row whose remaining columns are smallest in column
    order (NULLs first), i.e. ``row_number() over (partition by keys order by
    rest) = 1``. It is written as a grouped ``min(struct(rest))`` rather than
    a window so the engine combines duplicates map-side before the shuffle:
    a key holding millions of copies costs one row per map task, not one
    giant window partition in a single task.
    """
    # Times first: rows are sorted by the first key's value, and compared by the
    # others only where it is equal.
    times = [k for k in keys if isinstance(df.schema[k].dataType, (TimestampType, TimestampNTZType))]
    group = times + [k for k in keys if k not in times] + ([within] if within else [])
    rest = [c for c in df.columns if c not in group]
    if not rest:
        return df.dropDuplicates(group)
    out = df.groupBy(*group).agg(F.min(F.struct(*rest)).alias("__keep"))
    return out.select(*[F.col(c) for c in group], "__keep.*").select(*df.columns)


def bronze_transform(
    df: DataFrame, lo: int, hi: int, schema: StructType = TRIP_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """P2 -> P1 -> P3 -> P4 -> P5, then A17 on the good side.

    Returns ``(good, quarantine)``.
    """
    df = enforce_schema(df, schema)
    df = add_ingest_metadata(df)
    df = with_partition_year(df)
    good, bad = split_valid(df, lo, hi)
    return dedup_trips(good), bad
