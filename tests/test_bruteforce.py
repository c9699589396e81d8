"""Operators against brute-force Python on random small inputs."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripflow.operators import bronze, evaluate, platinum

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
BASE = dt.datetime(2024, 1, 1)

trip_row = st.tuples(
    st.sampled_from([1, 2, None]),             # VendorID
    st.integers(0, 3),                          # pickup offset (hours)
    st.sampled_from(["a", "b"]),                # source_file
    st.one_of(st.none(), st.integers(0, 3)),    # passenger_count
    st.one_of(st.none(), st.sampled_from([1.5, 2.5, 9.0])),  # fare_amount
)


def _key_none_first(v):
    return (v is not None, v if v is not None else 0)


@SETTINGS
@given(st.lists(trip_row, min_size=1, max_size=30))
def test_dedup_equals_first_in_sorted_order(spark, rows):
    data = [(v, BASE + dt.timedelta(hours=h), BASE + dt.timedelta(hours=h + 1), f, p, x)
            for v, h, f, p, x in rows]
    df = spark.createDataFrame(
        data, "VendorID BIGINT, tpep_pickup_datetime TIMESTAMP, tpep_dropoff_datetime TIMESTAMP, "
        "source_file STRING, passenger_count BIGINT, fare_amount DOUBLE")
    groups = defaultdict(list)
    for r in data:
        groups[(r[0], r[1], r[2], r[3])].append((r[4], r[5]))
    want = sorted(
        (k[0] or 0, k[1], k[3], *min(v, key=lambda t: (_key_none_first(t[0]), _key_none_first(t[1]))))
        for k, v in groups.items())
    got = sorted((r.VendorID or 0, r.tpep_pickup_datetime, r.source_file, r.passenger_count, r.fare_amount)
                 for r in bronze.dedup_trips(df).collect())
    norm = lambda rows: [tuple(-1 if x is None else x for x in r) for r in rows]
    assert sorted(norm(got)) == sorted(norm(want))


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 200)), min_size=1, max_size=60))
def test_demand_series_equals_dense_python_grid(spark, trips):
    rows = [(z, BASE + dt.timedelta(hours=h, minutes=7), 10.0 + h, 1.0, 1) for z, h in trips]
    df = spark.createDataFrame(
        rows, "pu_location_id BIGINT, pickup_datetime TIMESTAMP, fare_amount DOUBLE, "
        "trip_distance DOUBLE, passenger_count BIGINT").withColumn("pickup_hour", F.hour("pickup_datetime"))
    counts = defaultdict(int)
    for z, h in trips:
        counts[(z, h)] += 1
    totals = defaultdict(int)
    for (z, _), c in counts.items():
        totals[z] += c
    vals = sorted(totals.values())
    pos = 0.6 * (len(vals) - 1)
    lo = int(pos)
    thr = vals[lo] + (vals[min(lo + 1, len(vals) - 1)] - vals[lo]) * (pos - lo)
    zones = sorted(z for z, t in totals.items() if t >= thr)
    h0, h1 = min(h for _, h in trips), max(h for _, h in trips)
    want = {}
    for z in zones:
        series = [counts.get((z, h), 0) for h in range(h0, h1 + 1)]
        for i, h in enumerate(range(h0, h1 + 1)):
            lag = lambda n: series[i - n] if i >= n else None
            want[(z, h)] = (series[i], lag(1), lag(24), lag(168))
    got = {}
    for r in platinum.demand_series(df).collect():
        h = int((dt.datetime.combine(r.trip_date, dt.time()) - BASE).total_seconds() // 3600) + r.pickup_hour
        got[(r.pu_location_id, h)] = (r.trip_count, r.lag_1h, r.lag_24h, r.lag_168h)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 30), st.floats(0, 40, allow_nan=False)),
                min_size=1, max_size=40))
def test_zone_metrics_equal_python(spark, rows):
    df = spark.createDataFrame(rows, "pu_location_id BIGINT, trip_count BIGINT, prediction DOUBLE")
    got = {r.zone_id: r for r in evaluate.zone_metrics(df).collect()}
    by = defaultdict(list)
    for z, y, p in rows:
        by[z].append((y, p))
    for z, v in by.items():
        n = len(v)
        mae = sum(abs(y - p) for y, p in v) / n
        mape = sum(abs(y - p) / (y if y else 1) for y, p in v) / n * 100
        assert abs(got[z].mae - mae) <= 0.006
        assert abs(got[z].mape - mape) <= 0.006 * max(1, mape)
        if n < 2:
            assert got[z].r2 is None


names = st.one_of(
    st.builds(lambda y, m: f"year={y}/yellow_tripdata_{y}-{m:02d}.parquet",
              st.integers(2019, 2026), st.integers(1, 12)),
    st.sampled_from(["notes.txt", "year=2025/yellow_tripdata_2025-xx.parquet", "other.parquet"]),
)


@SETTINGS
@given(st.lists(names, max_size=12))
def test_landing_progress_equals_python(spark, files):
    from tripflow.sources import landing

    months = []
    for f in files:
        base = f.rsplit("/", 1)[-1]
        if base.startswith("yellow_tripdata_") and base.endswith(".parquet"):
            part = base[len("yellow_tripdata_"):-len(".parquet")]
            try:
                months.append(dt.datetime.strptime(part, "%Y-%m"))
            except ValueError:
                pass
    df = spark.createDataFrame([(f,) for f in files], "file_name STRING")
    r = landing.landing_progress(df, start="2025-01-01").first()
    if months:
        last = max(months)
        nxt = dt.date(last.year + last.month // 12, last.month % 12 + 1, 1)
        assert r.latest_month == last.date() and r.next_month == nxt
    else:
        assert r.latest_month is None and r.next_month == dt.date(2025, 1, 1)
