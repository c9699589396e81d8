"""Silver: renames, NULL defaults, flags, business rules, derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Silver column renames and NULL defaults.
TIME_RENAMES = {
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
}
ID_RENAMES = {
    "VendorID": "vendor_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "RatecodeID": "ratecode_id",
}
TRIP_DEFAULTS = {
    "passenger_count": 1,
    "RatecodeID": 99,
    "store_and_fwd_flag": "N",
    "congestion_surcharge": 0.0,
    "airport_fee": 0.0,
    "cbd_congestion_fee": 0.0,
}

# Business rules (inclusive ranges), and the fare-per-mile band
# (exclusive).
TRIP_RULES = {
    "fare_amount": (3, 200),
    "trip_distance": (0.5, 100),
    "passenger_count": (1, 6),
}
FARE_PER_MILE_BAND = (0, 100)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def fill_trip_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Replace NULL (not NaN) with the default, keeping each column's type."""
    defaults = TRIP_DEFAULTS if defaults is None else defaults
    cols = {
        c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
        for c, v in defaults.items()
        if c in df.columns
    }
    return df.withColumns(cols)


def add_trip_flags(df: DataFrame) -> DataFrame:
    """Airport, CBD and extra-charge flags. A NULL term in the charge sum makes
    the comparison NULL, which counts as 0."""
    charges = F.col("extra") + F.col("mta_tax") + F.col("tolls_amount") + F.col(
        "congestion_surcharge"
    )
    return df.withColumns(
        {
            "is_airport_trip": F.when(F.col("airport_fee") > 0, 1).otherwise(0),
            "is_cbd_trip": F.when(F.col("cbd_congestion_fee") > 0, 1).otherwise(0),
            "has_extra_charges": F.when(charges > 0, 1).otherwise(0),
        }
    )


def filter_valid_trips(
    df: DataFrame,
    rules: dict | None = None,
    pickup: str = "pickup_datetime",
    dropoff: str = "dropoff_datetime",
) -> DataFrame:
    """Inclusive range rules, positive total, dropoff after pickup. Any NULL
    operand drops the row."""
    rules = TRIP_RULES if rules is None else rules
    cond = (F.col("total_amount") > 0) & (F.col(dropoff) > F.col(pickup))
    for c, (lo, hi) in rules.items():
        cond = cond & F.col(c).between(lo, hi)
    return df.filter(cond)


def add_calendar(
    df: DataFrame, pickup: str = "pickup_datetime", dropoff: str = "dropoff_datetime"
) -> DataFrame:
    """Trip date and year from the dropoff; hour, weekday (1 = Sunday), month
    and year from the pickup."""
    return df.withColumns(
        {
            "trip_date": F.to_date(dropoff),
            "trip_year": F.year(dropoff),
            "pickup_hour": F.hour(pickup),
            "pickup_day": F.dayofweek(pickup),
            "pickup_month": F.month(pickup),
            "pickup_year": F.year(pickup),
        }
    )


def add_extra_charges(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "extra_charges", F.round(F.col("total_amount") - F.col("fare_amount"), 2)
    )


def add_duration(
    df: DataFrame, pickup: str = "pickup_datetime", dropoff: str = "dropoff_datetime"
) -> DataFrame:
    """Whole-second duration (each timestamp truncated to its second), rows
    with a non-positive duration dropped, minutes rounded to 2 places."""
    secs = F.unix_seconds(F.col(dropoff).cast("timestamp")) - F.unix_seconds(
        F.col(pickup).cast("timestamp")
    )
    return (
        df.withColumn("trip_duration_seconds", secs)
        .filter(F.col("trip_duration_seconds") > 0)
        .withColumn(
            "trip_duration_minutes", F.round(F.col("trip_duration_seconds") / 60, 2)
        )
    )


def add_fare_per_mile(df: DataFrame, band: tuple = FARE_PER_MILE_BAND) -> DataFrame:
    lo, hi = band
    fpm = F.round(F.try_divide(F.col("fare_amount"), F.col("trip_distance")), 2)
    return df.withColumn("fare_per_mile", fpm).filter(
        (F.col("fare_per_mile") > lo) & (F.col("fare_per_mile") < hi)
    )


def silver_transform(bronze: DataFrame) -> DataFrame:
    """Bronze rows -> Silver rows (P6-P14), one lazy chain."""
    df = rename(bronze, TIME_RENAMES)
    df = fill_trip_defaults(df)
    df = add_trip_flags(df)
    df = filter_valid_trips(df)
    df = add_calendar(df)
    df = add_extra_charges(df)
    df = add_duration(df)
    df = add_fare_per_mile(df)
    df = df.drop("source_file")
    return rename(df, ID_RENAMES)
