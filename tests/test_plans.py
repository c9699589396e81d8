"""Physical-plan shape: pushdown, pruning, no cross joins, map-side combine."""

import re

import pytest

from tests.conftest import SMALL
from tripflow.operators import bronze
from tripflow.plans import inputs
from tripflow.plans.queries import REGISTRY


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_scan_prunes_columns_and_pushes_filters(spark):
    p = plan(REGISTRY["fact_trip_yearly_summary"](spark, SMALL))
    pushed = re.search(r"PushedFilters: \[([^\]]*)", p)
    assert pushed and "IsNotNull(l_" in pushed[1], pushed
    # The fact needs few lineitem columns; the comment column family is never read.
    assert "ReadSchema: struct<l_orderkey" in p
    assert "l_comment" not in p


def test_demand_series_has_no_cross_join(spark):
    p = plan(inputs.demand_series(spark, SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "Generate explode(sequence" in p


def test_dedup_combines_map_side(spark):
    good, _ = bronze.split_valid(bronze.with_partition_year(inputs.typed_trips(spark, SMALL)), 1996, 2000)
    p = plan(bronze.dedup_trips(good))
    assert "partial_min" in p
    assert "Window" not in p


def test_facts_aggregate_partially_before_shuffle(spark):
    p = plan(REGISTRY["fact_location_summary"](spark, SMALL))
    assert "partial_sum" in p and "Exchange hashpartitioning" in p


def test_demand_series_reads_trips_once(spark):
    """After the hourly aggregate is checkpointed, the series plan scans no
    files: totals, threshold, bounds, grid and join all read the checkpoint."""
    p = plan(inputs.demand_series(spark, SMALL))
    assert "FileScan" not in p and "Scan ExistingRDD" in p


def test_partitioned_writes_rebalance(spark):
    from tripflow.sources.tables import _cluster

    df = inputs.silver_trips(spark, SMALL)
    p = plan(_cluster(df, "trip_year"))
    assert "REBALANCE_PARTITIONS_BY_COL" in p


def test_one_pass_facts_scan_once(spark):
    from tripflow.operators import gold

    p = plan(gold.fact_grouping_sets(inputs.silver_trips(spark, SMALL)))
    assert p.count("FileScan parquet") == 1 and "Expand" in p
    assert p.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["landing_progress", "fact_trip_yearly_summary", "row_counts"])
def test_scans_of_the_trips(spark, name):
    n = {"row_counts": 3}.get(name, 1)
    assert len(re.findall(r"FileScan parquet[^\n]*lineitem", plan(REGISTRY[name](spark, SMALL)))) == n


@pytest.mark.parametrize("name", ["hour_zone_grid", "densify", "fill_missing_hours", "add_series_calendar"])
def test_series_parts_read_the_checkpoint_only(spark, name):
    assert "FileScan" not in plan(REGISTRY[name](spark, SMALL))
