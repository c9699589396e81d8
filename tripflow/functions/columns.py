"""Column-level helpers (built-in expressions only, so they stay in codegen)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label maps and canonical orders used by the views.
DAY_TYPE = {0: "Weekday", 1: "Weekend"}
DOW_ORDER = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_values(c, mapping: dict) -> Column:
    """Look a value up in a fixed map (NULL when absent)."""
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items())
    return F.create_map(*pairs)[_col(c)]


def dow_name(c) -> Column:
    """Three-letter weekday name (Mon ... Sun)."""
    return F.date_format(_col(c), "E")


def dow_monday0(c) -> Column:
    """Weekday number with Monday = 0 ... Sunday = 6."""
    return F.weekday(_col(c))


def month_name(c) -> Column:
    """Three-letter month name of a date (Jan ... Dec)."""
    return F.date_format(_col(c), "MMM")


def month_label(c) -> Column:
    """``Jan 2024`` style label."""
    return F.date_format(_col(c), "MMM yyyy")


def month_number_name(c) -> Column:
    """Month name from a month number 1-12."""
    return F.date_format(F.make_date(F.lit(2000), _col(c), F.lit(1)), "MMM")


def clip_nonneg(c) -> Column:
    """Predictions below zero become zero; a missing one stays missing."""
    x = _col(c).cast("double")
    return F.when(x < 0, 0.0).otherwise(x)


def with_share(df, c: str, name: str):
    """Value over the frame's total. The total is a scalar subquery (one
    aggregate), not an unpartitioned window, so no single task ever holds
    the frame."""
    total = df.select(F.sum(F.col(c))).scalar()
    return df.withColumn(name, F.try_divide(F.col(c), total))


def capitalize(c) -> Column:
    return F.initcap(_col(c))
