"""Data profiling: stage row counts, descriptive statistics, distinct counts.

Each profile is one aggregation pass producing a small long-format frame
(one row per stage or per column), instead of several display actions that
rescan the input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegralType, NumericType, StringType


def row_counts(**stages: DataFrame) -> DataFrame:
    """A1: one row per named stage with its row count."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("stage"), "row_count"
        )
        for name, df in stages.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def described_columns(df: DataFrame) -> list[str]:
    """Columns with statistics: numbers and strings."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (NumericType, StringType))]


def profile_describe(df: DataFrame, cols=None) -> DataFrame:
    """A2: count, mean, sample stddev, min and max of each number column, count
    and first and last text of each string column, in one pass, one row per
    column."""
    cols = described_columns(df) if cols is None else list(cols)
    text = {c: isinstance(df.schema[c].dataType, StringType) for c in cols}
    number, none = "double", F.lit(None)
    aggs, rows = [], []
    for i, c in enumerate(cols):
        x = F.col(c) if text[c] else F.col(c).cast(number)
        parts = {"count": F.count(x)}
        if text[c]:
            parts |= {"mean": none.cast(number), "stddev": none.cast(number), "min": none.cast(number), "max": none.cast(number), "min_text": F.min(x), "max_text": F.max(x)}
        else:
            parts |= {"mean": F.avg(x), "stddev": F.stddev_samp(x), "min": F.min(x), "max": F.max(x), "min_text": none.cast("string"), "max_text": none.cast("string")}
        aggs.append(F.struct(F.lit(c).alias("column"), *(v.alias(k) for k, v in parts.items())).alias(f"c{i}"))
        rows.append(F.col(f"c{i}"))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def profile_summary(df: DataFrame, cols) -> DataFrame:
    """A3: Spark's ``summary()`` (count, mean, stddev, min, approximate
    quartiles, max) for the given columns."""
    return df.select(*cols).summary()


def profile_distinct(df: DataFrame, rsd: float = 0.05, cols=None) -> DataFrame:
    """A4: HyperLogLog++ distinct-count estimate per column, one pass, one row
    per column (relative standard deviation ``rsd``)."""
    cols = df.columns if cols is None else list(cols)
    wide = df.agg(
        *[F.approx_count_distinct(F.col(c), rsd).alias(f"d{i}") for i, c in enumerate(cols)]
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("approx_distinct"))
            for i, c in enumerate(cols)
        ]
    )
    return wide.select(F.inline(rows))


def exact_distinct(df: DataFrame, cols=None) -> DataFrame:
    """Exact distinct counts, one row per column. Each column is read and grouped
    on its own; counted side by side, every row would be copied once a column."""
    cols = df.columns if cols is None else list(cols)
    parts = [df.agg(F.count_distinct(F.col(c)).alias("distinct_values")).select(F.lit(c).alias("column"), "distinct_values") for c in cols]
    return reduce(lambda a, b: a.unionByName(b), parts)


# ------------------------------------------------------------ stored sketches
#: Buckets of a distinct-count sketch, as a power of two: a relative standard
#: error of about 1.04 / sqrt(2 ** 12), 1.6 %.
HLL_BITS = 12
DISTINCT_ERROR = 1.04 / 2 ** (HLL_BITS / 2)
#: Size of a quantile sketch, and its normalised rank error at 99 % confidence.
KLL_K = 400
RANK_ERROR = 0.0068
QUARTILES = (0.25, 0.5, 0.75)


def sketch_state(df: DataFrame, load: str = "load_id", cols=None) -> DataFrame:
    """A3/A4 of each load: one row (load, column, rows, distinct, quantiles) a
    column, in one pass. ``distinct`` is a HyperLogLog sketch, ``quantiles`` a KLL
    sketch of a number column without its NULLs and NaNs; both merge over loads."""
    cols = [c for c in df.columns if c != load] if cols is None else list(cols)
    aggs, rows = [], []
    for k, c in enumerate(cols):
        kind = df.schema[c].dataType
        number = isinstance(kind, NumericType)
        own = F.col(c) if isinstance(kind, (IntegralType, StringType)) else F.col(c).cast("string")
        if isinstance(kind, IntegralType):
            own = own.cast("long")
        real = F.col(c).cast("double")
        sketch = F.kll_sketch_agg_double(F.when(~F.isnan(real), real), KLL_K) if number and not isinstance(kind, BooleanType) else F.lit(None).cast("binary")
        parts = [F.count(c).alias("rows"), F.hll_sketch_agg(own, HLL_BITS).alias("distinct"), (F.first(sketch) if not number else sketch).alias("quantiles")]
        aggs.append(F.struct(F.lit(c).alias("column"), *parts).alias(f"c{k}"))
        rows.append(F.col(f"c{k}"))
    return df.groupBy(load).agg(*aggs).select(load, F.inline(F.array(*rows)))


def merge_sketches(state: DataFrame, shares=QUARTILES) -> DataFrame:
    """``column``, ``rows``, ``approx_distinct`` and ``quantiles`` (NULL where the
    column has no numbers) over all loads of the state: no row is read again."""
    merged = state.groupBy("column").agg(F.sum("rows").alias("rows"), F.hll_union_agg("distinct").alias("d"), F.kll_merge_agg_double("quantiles").alias("q"))
    wanted = F.array(*[F.lit(float(s)) for s in shares])
    some = F.col("q").isNotNull() & (F.kll_sketch_get_n_double("q") > 0)
    return merged.select("column", "rows", F.hll_sketch_estimate("d").alias("approx_distinct"), F.when(some, F.kll_sketch_get_quantile_double("q", wanted)).alias("quantiles"))
