"""Boundary and NULL behaviour on tiny inline frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripflow.operators import bronze, evaluate, forecast, gold, history, platinum, silver


def ts(h=0, m=0, s=0, us=0, day=1):
    return dt.datetime(2024, 1, day, h, m, s, us)


def trip_rows(spark, rows):
    schema = (
        "fare_amount DOUBLE, total_amount DOUBLE, trip_distance DOUBLE, passenger_count BIGINT, "
        "pickup_datetime TIMESTAMP, dropoff_datetime TIMESTAMP"
    )
    return spark.createDataFrame(rows, schema)


def test_business_rules_edges(spark):
    ok = (10.0, 12.0, 5.0, 2, ts(1), ts(2))
    rows = [
        (2.99, 5.0, 5.0, 2, ts(1), ts(2)),    # fare below
        (3.0, 5.0, 5.0, 2, ts(1), ts(2)),     # fare lower edge kept
        (200.0, 205.0, 5.0, 2, ts(1), ts(2)), # fare upper edge kept
        (200.01, 205.0, 5.0, 2, ts(1), ts(2)),
        (10.0, 12.0, 0.49, 2, ts(1), ts(2)),
        (10.0, 12.0, 0.5, 2, ts(1), ts(2)),
        (10.0, 12.0, 100.0, 2, ts(1), ts(2)),
        (10.0, 12.0, 100.01, 2, ts(1), ts(2)),
        (10.0, 12.0, 5.0, 0, ts(1), ts(2)),
        (10.0, 12.0, 5.0, 1, ts(1), ts(2)),
        (10.0, 12.0, 5.0, 6, ts(1), ts(2)),
        (10.0, 12.0, 5.0, 7, ts(1), ts(2)),
        (10.0, 12.0, 5.0, None, ts(1), ts(2)),  # NULL passengers dropped
        (10.0, 0.0, 5.0, 2, ts(1), ts(2)),      # total not > 0
        (10.0, 12.0, 5.0, 2, ts(2), ts(2)),     # dropoff not after pickup
        (10.0, 12.0, 5.0, 2, ts(1), None),      # NULL dropoff
        ok,
    ]
    kept = silver.filter_valid_trips(trip_rows(spark, rows)).collect()
    fares = sorted((r.fare_amount, r.trip_distance, r.passenger_count) for r in kept)
    assert fares == sorted([
        (3.0, 5.0, 2), (200.0, 5.0, 2), (10.0, 0.5, 2), (10.0, 100.0, 2),
        (10.0, 5.0, 1), (10.0, 5.0, 6), (10.0, 5.0, 2),
    ])


def test_sub_second_trip_has_zero_duration_and_is_dropped(spark):
    df = trip_rows(spark, [(10.0, 12.0, 5.0, 2, ts(1, 0, 0, 300000), ts(1, 0, 0, 700000)),
                           (10.0, 12.0, 5.0, 2, ts(1, 0, 0, 900000), ts(1, 0, 1, 100000))])
    out = silver.add_duration(df).collect()
    assert [r.trip_duration_seconds for r in out] == [1]


def test_fare_per_mile_band_is_exclusive(spark):
    df = trip_rows(spark, [(100.0, 1.0, 1.0, 1, ts(1), ts(2)), (99.99, 1.0, 1.0, 1, ts(1), ts(2)),
                           (3.0, 1.0, 0.5, 1, ts(1), ts(2))])
    out = sorted(r.fare_per_mile for r in silver.add_fare_per_mile(df).collect())
    assert out == [6.0, 99.99]


def test_distance_buckets(spark):
    df = spark.createDataFrame([(x,) for x in (1.99, 2.0, 9.99, 10.0)], "trip_distance DOUBLE")
    got = [r.distance_bucket for r in gold.add_distance_bucket(df).orderBy("trip_distance").collect()]
    assert got == ["short", "medium", "medium", "long"]


def test_null_charge_gives_zero_flag(spark):
    df = spark.createDataFrame(
        [(None, 0.5, 1.0, 2.5, 0.0, 0.0), (1.0, 0.5, 0.0, 0.0, 1.75, 0.75)],
        "extra DOUBLE, mta_tax DOUBLE, tolls_amount DOUBLE, congestion_surcharge DOUBLE, "
        "airport_fee DOUBLE, cbd_congestion_fee DOUBLE",
    )
    got = [(r.has_extra_charges, r.is_airport_trip, r.is_cbd_trip) for r in silver.add_trip_flags(df).collect()]
    assert got == [(0, 0, 0), (1, 1, 1)]


def test_defaults_replace_null_not_nan(spark):
    df = spark.createDataFrame([(None, float("nan"))], "passenger_count BIGINT, airport_fee DOUBLE")
    r = silver.fill_trip_defaults(df).first()
    assert r.passenger_count == 1 and r.airport_fee != r.airport_fee  # NaN kept


def test_split_is_exact_complement_with_null_year(spark):
    df = spark.createDataFrame([(1995,), (1996,), (2000,), (2001,), (None,)], "year INT")
    good, bad = bronze.split_valid(df, 1996, 2000)
    assert sorted(r.year for r in good.collect()) == [1996, 2000]
    assert sorted((r.year for r in bad.collect()), key=lambda x: (x is not None, x)) == [None, 1995, 2001]


def test_airport_fee_spelling_is_normalised_then_typed(spark):
    df = spark.createDataFrame([("1.75", "3")], "Airport_fee STRING, passenger_count STRING")
    out = bronze.enforce_schema(df)
    assert "airport_fee" in out.columns and "Airport_fee" not in out.columns
    r = out.first()
    assert r.airport_fee == 1.75 and r.passenger_count == 3
    assert dict(out.dtypes)["airport_fee"] == "double"
    # Declared but absent columns arrive as typed NULLs (cbd_congestion_fee).
    assert r.cbd_congestion_fee is None and dict(out.dtypes)["cbd_congestion_fee"] == "double"


def test_bad_text_in_numeric_column_becomes_null(spark):
    df = spark.createDataFrame([("abc",)], "fare_amount STRING")
    assert bronze.enforce_schema(df).first().fare_amount is None


def test_dedup_keeps_smallest_rest_within_file(spark):
    rows = [
        (1, ts(1), ts(2), "a", 2, 5.0),
        (1, ts(1), ts(2), "a", None, 9.0),  # NULL sorts first -> survives
        (1, ts(1), ts(2), "b", 3, 1.0),     # other file -> kept
        (None, ts(1), ts(2), "a", 4, 1.0),  # NULL vendor is a key value
        (None, ts(1), ts(2), "a", 5, 1.0),
    ]
    df = spark.createDataFrame(
        rows, "VendorID BIGINT, tpep_pickup_datetime TIMESTAMP, tpep_dropoff_datetime TIMESTAMP, "
        "source_file STRING, passenger_count BIGINT, fare_amount DOUBLE")
    out = sorted(
        ((r.VendorID or 0), r.source_file, r.passenger_count) for r in bronze.dedup_trips(df).collect()
    )
    assert out == [(0, "a", 4), (1, "a", None), (1, "b", 3)]
    assert bronze.dedup_trips(df).columns == df.columns


def test_series_calendar_flags(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 6), h) for h in (5, 6, 7, 10, 11, 16, 19, 20, 21, 22)]
        + [(dt.date(2024, 1, 8), 0)],
        "trip_date DATE, pickup_hour INT")
    out = {(r.trip_date.day, r.pickup_hour): (r.is_weekend, r.is_rush_hour, r.is_night)
           for r in platinum.add_series_calendar(df).collect()}
    assert out[(6, 5)] == (1, 0, 1) and out[(6, 6)] == (1, 0, 0)
    assert out[(6, 7)] == (1, 1, 0) and out[(6, 10)] == (1, 1, 0) and out[(6, 11)] == (1, 0, 0)
    assert out[(6, 16)][1] == 1 and out[(6, 19)][1] == 1 and out[(6, 20)][1] == 0
    assert out[(6, 21)][2] == 0 and out[(6, 22)][2] == 1 and out[(8, 0)] == (0, 0, 1)


def test_sparse_hours_zero_fill_and_lags(spark):
    """One zone with a 30-hour gap: zero-filled, lag = value n hours back."""
    hours = [h for h in range(60) if not 10 <= h < 40]
    base = dt.datetime(2024, 1, 1)
    trips = spark.createDataFrame(
        [(7, base + dt.timedelta(hours=h, minutes=5), 10.0, 2.0, 1) for h in hours],
        "pu_location_id BIGINT, pickup_datetime TIMESTAMP, fare_amount DOUBLE, trip_distance DOUBLE, "
        "passenger_count BIGINT",
    ).withColumn("pickup_hour", F.hour("pickup_datetime"))
    ds = platinum.demand_series(trips).orderBy("trip_date", "pickup_hour").collect()
    assert len(ds) == 60
    counts = [r.trip_count for r in ds]
    assert counts == [0 if 10 <= h < 40 else 1 for h in range(60)]
    assert [r.lag_24h for r in ds[24:]] == counts[:36]
    assert all(r.lag_168h is None for r in ds)
    assert ds[20].avg_fare == 0.0


def test_demand_bucket_edges(spark):
    df = spark.createDataFrame([(x,) for x in (0, 10, 11, 50, 51, 200, 201)], "trip_count BIGINT")
    got = [r.bucket_order for r in evaluate.add_demand_bucket(df).orderBy("trip_count").collect()]
    assert got == [0, 0, 1, 1, 2, 2, 3]


def test_metrics_zero_actuals_and_constant_r2(spark):
    df = spark.createDataFrame(
        [(1, 0, 1.0), (1, 0, 0.0), (2, 3, 3.0), (2, 3, 3.0), (3, 5, 4.0)],
        "pu_location_id BIGINT, trip_count BIGINT, prediction DOUBLE")
    m = {r.zone_id: r for r in evaluate.zone_metrics(df).collect()}
    assert m[1].mape == 50.0          # zero actual -> denominator 1
    assert m[1].r2 == 0.0             # constant actuals, non-zero error
    assert m[2].r2 == 1.0             # constant actuals, exact
    assert m[3].r2 is None            # fewer than two rows
    b = {r.demand_bucket: r.mape for r in evaluate.mape_by_bucket(df).collect()}
    assert len(b) == 4 and b["high (200+)"] is None


def test_driver_rounding_half_to_even(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1), 5.0), (2, dt.datetime(2024, 1, 1), 7.0)],
        "pu_location_id BIGINT, datetime TIMESTAMP, trip_count DOUBLE")
    out = {r.pu_location_id: r.avg_drivers for r in forecast.driver_requirement(df, 2.0).collect()}
    assert out == {1: 2, 2: 4}
    with pytest.raises(ValueError):
        forecast.driver_requirement(df, 5.0)


def test_unmatched_codes_excluded_from_views(spark):
    fact = spark.createDataFrame([(1996, 1, 10, 100.0, 10.0), (1996, 9, 5, 50.0, 10.0)],
                                 "trip_year INT, payment_type BIGINT, total_trips BIGINT, "
                                 "total_revenue DOUBLE, avg_trip_value DOUBLE")
    mix = history.payment_mix(history.enrich_payment(fact, gold.dim_payment_type(spark))).collect()
    assert [(r.payment_name, r.total_trips, r.trip_share) for r in mix] == [("Credit Card", 10, 1.0)]


def test_tied_top_k_breaks_on_key(spark):
    fact = spark.createDataFrame(
        [(1996, 1, 1, 10.0, 5.0, "Zb", "B"), (1996, 2, 1, 10.0, 5.0, "Za", "B")],
        "trip_year INT, pu_location_id BIGINT, total_trips BIGINT, total_revenue DOUBLE, "
        "avg_trip_value DOUBLE, zone STRING, borough STRING")
    top = history.top_zones_by_revenue(fact, 1).collect()
    assert top[0].zone == "Za"


def test_since_bound_keeps_grid_from_stretching(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(7, base + dt.timedelta(hours=h), 10.0, 2.0, 1) for h in range(5)]
    rows.append((7, dt.datetime(2010, 1, 1), 10.0, 2.0, 1))  # stray ancient pickup
    trips = spark.createDataFrame(
        rows, "pu_location_id BIGINT, pickup_datetime TIMESTAMP, fare_amount DOUBLE, trip_distance DOUBLE, "
        "passenger_count BIGINT").withColumn("pickup_hour", F.hour("pickup_datetime"))
    assert platinum.demand_series(trips, since="2023-12-31").count() == 5
    assert platinum.demand_series(trips).count() > 100_000
