"""Layers kept load by load against layers built whole."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.test_plans import plan
from tripflow.functions.output import round_doubles
from tripflow.operators import platinum
from tripflow.plans.live import Live
from tripflow.plans.medallion import Medallion, land_files
from tripflow.plans.queries import SILVER_COLUMNS
from tripflow.session import scratch_path
from tripflow.sources import fixtures, loading, tables

LO, HI = fixtures.TRIPS_VALID_YEARS


def same(a, b):
    a, b = round_doubles(a), round_doubles(b.select(*a.columns))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def two_loads(spark):
    root = scratch_path(spark, "live_test")
    raw = fixtures.raw_trips(spark, SMALL).drop("source_file")
    y = F.coalesce(F.year("tpep_dropoff_datetime"), F.lit(0))
    m = Medallion(spark, f"{root}/tables")
    land_files(raw.filter(y < 1998), f"{root}/landing/0")
    m.load_bronze(f"{root}/landing", LO, HI)
    m.live.refresh()
    first = m.live.pending("silver"), {r.trip_year for r in m.silver().select("trip_year").distinct().collect()}
    land_files(raw.filter(y >= 1998), f"{root}/landing/1")
    m.load_bronze(f"{root}/landing", LO, HI)
    return m, first


def test_a_refresh_reads_only_touched_years(spark, two_loads):
    m, (pending, years) = two_loads
    assert pending == [] and years == {1996, 1997}
    old_files = lambda: {f for f in m.silver().inputFiles() if "trip_year=1996" in f or "trip_year=1997" in f}
    files = old_files()
    loads = m.live.pending("silver")
    assert len(loads) == 1
    touched = m.live.refresh_silver()
    assert set(touched) == {1998, 1999, 2000} & set(touched) and touched
    # The partitions of other years are the same files.
    assert files and files == old_files()
    p = plan(m.io.read("bronze").where(F.col("year").isin(touched)))
    assert "PartitionFilters: [" in p and "year" in p.split("PartitionFilters: [")[1].split("]")[0]
    live = m.silver().select(*SILVER_COLUMNS).persist()
    assert live.count() > 0 and m.live.refresh_silver() == []
    m.build_silver()
    assert same(live, m.silver())


def test_facts_and_profile_equal_whole_builds(spark, two_loads):
    m, _ = two_loads
    for refresh in (m.live.refresh_facts, m.live.refresh_profile):
        refresh()
        refresh()  # nothing is added twice
    m.live.refresh_silver()
    m.build_gold(fixtures.raw_zone_lookup(spark, SMALL))
    for name, fact in m.live.facts().items():
        assert same(fact, m.fact(name)), name
    assert "load_id" in plan(m.live.bronze_of(["x"])).split("PartitionFilters: [")[1].split("]")[0]
    got = {r.column: r for r in m.live.profile().collect()}
    rows = m.io.read("bronze")
    assert got["VendorID"].rows == rows.where("VendorID IS NOT NULL").count()
    assert got["store_and_fwd_flag"].quantiles is None and len(got["fare_amount"].quantiles) == 3


def test_uncommitted_rows_are_never_seen(spark, two_loads):
    m, _ = two_loads
    m.live.refresh_silver()
    before = m.silver().count()
    ghost = m.io.read("bronze").limit(50).withColumn("load_id", F.lit("ghost"))
    m.io.overwrite(ghost, "bronze", ["load_id", "year"], only_partitions=True)
    assert "ghost" not in m.live.pending("silver")
    m.build_silver()
    assert m.silver().count() == before
    assert {r.stage: r.row_count for r in loading.row_counts(m.io).collect()}["bronze"] == loading.committed(m.io, "bronze").count()


def trips(spark, hours, zones=5, n=3, start="2024-01-20 00:00:00"):
    base = spark.range(hours * zones * n).select(
        (F.col("id") % zones).alias("pu_location_id"),
        (F.lit(start).cast("timestamp") + F.make_dt_interval(F.lit(0), (F.floor(F.col("id") / (zones * n))).cast("int"))).alias("pickup_datetime"),
        (F.col("id") % 17).cast("double").alias("fare_amount"), (F.col("id") % 5).cast("double").alias("trip_distance"), F.lit(1).alias("passenger_count"),
    )
    return base.where((F.col("pu_location_id") > 2) | (F.xxhash64("id") % 3 == 0)).withColumn("pickup_hour", F.hour("pickup_datetime"))


@pytest.mark.parametrize("case", ["later", "late_arrival", "earlier", "zones_change"])
def test_series_equals_rebuild(spark, case):
    io = tables.TableIO(spark, scratch_path(spark, "live_series_test"))
    loading.create_tables(io)
    live = Live(io)
    first = trips(spark, 24 * 30)
    more = {
        "later": trips(spark, 24 * 9, start="2024-02-19 00:00:00"),
        "late_arrival": trips(spark, 30, start="2024-02-10 07:00:00"),
        "earlier": trips(spark, 24, start="2024-01-18 00:00:00"),
        "zones_change": trips(spark, 24 * 9, n=40, start="2024-02-19 00:00:00").withColumn("pu_location_id", F.col("pu_location_id") % 3),
    }[case]
    how = []
    for k, part in enumerate((first, more)):
        loading.ledger_of(io).append(spark.createDataFrame([(f"f{k}",)], "file_name STRING"), load_id=f"l{k}")
        how.append(live.refresh_series(lambda loads, part=part: part.withColumn("load_id", F.lit(loads[0]))))
    assert how == ["whole", "2024-02" if case in ("later", "late_arrival") else "whole"]
    assert live.refresh_series() == "nothing"
    whole = platinum.demand_series(first.unionByName(more))
    assert whole.count() > 0 and same(whole, live.series())
