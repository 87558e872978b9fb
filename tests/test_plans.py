"""Plan-shape guards over every registered query (sf0.001): no window over a whole unpartitioned table,
split predicates reach the parquet scan, and only needed columns are read."""

import json

import pytest

import __spark_entry__ as entry
from tripflow.queries import QUERIES

SF = "/root/testdata/sf0.001"
SKIP = {"gbt_scoring", "feature_importance", "stream_scoring", "monthly_union"}  # fit/write at plan time; shape covered elsewhere


def _nodes(plan_json):
    return json.loads(plan_json)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_global_window(spark, name):
    df = entry.queries()[name](spark, SF)
    nodes = _nodes(df._jdf.queryExecution().optimizedPlan().toJSON())
    windows = [n for n in nodes if n.get("class", "").endswith("logical.Window")]
    assert all(n.get("partitionSpec") for n in windows), f"{name}: a window without partitionBy"


def test_split_predicate_and_pruning_reach_the_scan(spark):
    df = entry.queries()["segment_metrics"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.split("\n") if "FileScan parquet" in line and "events" in line]
    assert scan, plan
    assert "GreaterThanOrEqual(ts" in scan[0] or "GreaterThan(ts" in scan[0]
    assert "event_type" not in scan[0].split("ReadSchema")[-1]  # unused column is pruned


def _executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["zone_enriched", "feature_matrix", "segment_metrics"])
def test_dimension_lookups_are_broadcast(spark, name):
    plan = _executed(entry.queries()[name](spark, SF))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, plan


@pytest.mark.parametrize("name", ["segment_metrics", "split_report", "split_metrics", "lineage_coverage"])
def test_big_aggregations_combine_map_side(spark, name):
    """A hot key is pre-aggregated in every task: a partial aggregate sits below each shuffle of the big table."""
    plan = _executed(entry.queries()[name](spark, SF))
    assert "partial_" in plan, plan


def test_fit_summary_is_one_partial_aggregate(spark):
    from tripflow.plans.features import fit_summary
    from tripflow.queries import Inputs

    df = fit_summary(Inputs(spark, SF).prepared("train"))
    plan = _executed(df)
    assert plan.count("partial_count") == 1 and "Window" not in plan


def test_results_above_a_broadcast_limit_are_the_same(spark):
    """Beyond the row limit the lookups are not broadcast by us; the answers stay."""
    from tripflow.operators.joins import checked_zones, enrich_zones
    from tripflow.sources import adapter

    raw = adapter.raw_trips(spark, SF).select("trip_id", "PULocationID", "DOLocationID")
    zones = adapter.zones(spark, SF)
    few, many = checked_zones(zones, max_rows=3), checked_zones(zones)
    assert few.side() is few.df and many.side() is not many.df
    assert sorted(enrich_zones(raw, few).collect()) == sorted(enrich_zones(raw, many).collect())
