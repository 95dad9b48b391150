"""Plan shape: the physical plans are the ones intended for scale."""

from __future__ import annotations

import pytest

from conftest import SMOKE_DIR
from pickmarts.plans.driver_queries import all_queries


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def q():
    return all_queries()


def _final(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_no_python_udf_cross_join_or_nested_loop(spark, q):
    for name, build in q.items():
        plan = _plan(build(spark, SMOKE_DIR))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


@pytest.mark.parametrize("name", ["sk_position_in_order", "pick_errors_origin", "weekly_zscore_distribution"])
def test_final_plans_too(spark, q, name):
    plan = _final(q[name](spark, SMOKE_DIR))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)


def test_top_n_uses_group_limit(spark, q):
    df = q["top_n_products_weekly"](spark, SMOKE_DIR)
    df.explain()  # keeps the formatted plan in the test log
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in text


@pytest.mark.parametrize(
    "name", ["top_n_products_weekly", "warehouse_utilization_per_section", "pick_errors", "total_pick_volume"]
)
def test_calendar_is_looked_up_after_the_first_aggregate(spark, q, name):
    plan = q[name](spark, SMOKE_DIR)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    depth = lambda x: len(x) - len(x.lstrip(" :+-!"))
    scan = next(i for i, x in enumerate(lines) if "l_shipdate" in x and "Relation" in x)
    above = [x for i, x in enumerate(lines[:scan]) if depth(x) < depth(lines[scan])]
    joins = [i for i, x in enumerate(above) if "Join" in x]
    aggregates = [i for i, x in enumerate(above) if "Aggregate" in x]
    # printed top down: an aggregate stands between every join and the scan
    assert joins and all(any(a > j for a in aggregates) for j in joins), plan


def test_one_fact_scan_and_no_product_scan_for_errors(spark, q):
    plan = _plan(q["pick_errors"](spark, SMOKE_DIR))
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x]
    assert len(scans) == 1 and "lineitem" in scans[0]


def test_sign_filter_reaches_the_scan(spark, q):
    plan = _plan(q["total_pick_volume"](spark, SMOKE_DIR))
    assert "l_tax" in plan.split("PushedFilters: [")[1].split("]")[0]
    assert "part.parquet" not in plan


def test_scan_reads_only_needed_columns(spark, q):
    plan = _plan(q["pick_throughput_hourly"](spark, SMOKE_DIR))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "lineitem" in line][0]
    for unused in ("l_extendedprice", "l_suppkey", "l_linestatus"):
        assert unused not in scan


def test_one_fact_scan_for_section_shares(spark, q):
    plan = _plan(q["warehouse_utilization_per_section"](spark, SMOKE_DIR))
    assert sum(1 for line in plan.splitlines() if "FileScan parquet" in line and "lineitem" in line) == 1


def test_zscore_stats_broadcast_not_windowed(spark, q):
    plan = _plan(q["weekly_zscore_distribution"](spark, SMOKE_DIR))
    assert "Window" not in plan


def test_zscore_branches_share_one_aggregate_exchange(spark, q):
    df = q["weekly_zscore_distribution"](spark, SMOKE_DIR)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final
    assert sum(1 for line in final.splitlines() if "FileScan parquet" in line and "lineitem" in line) == 1
