"""Drill-down families from one pass: the same rows as the single marts, one scan, one Expand."""

from __future__ import annotations

import os
import re

import pytest

from conftest import SMOKE_DIR, calendar, fact_row, facts, rows_of
from pickmarts.operators import families
from pickmarts.operators.errors import pick_errors
from pickmarts.operators.throughput import pick_throughput_weekly
from pickmarts.operators.top_products import top_n_products_weekly
from pickmarts.operators.volume import total_orders_processed, total_pick_volume
from pickmarts.plans import full_run
from pickmarts.plans.driver_queries import all_queries, stage_driver_tables
from pickmarts.plans.registry import FAMILIES, MARTS, Facts

SINGLE = {
    "total_pick_volume": lambda f, g: total_pick_volume(f.f_order_picks, f.d_date, g),
    "total_orders_processed": lambda f, g: total_orders_processed(f.f_order_picks, f.d_date, g),
    "pick_errors": lambda f, g: pick_errors(f.f_order_picks, f.f_pick_errors, f.d_date, g),
    "top_n_products_weekly": lambda f, g: top_n_products_weekly(f.f_order_picks, f.d_date, g),
    "pick_throughput_weekly": lambda f, g: pick_throughput_weekly(f.f_order_picks, f.d_date, g),
}


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs in every drill-down, days outside the calendar, days without picks, ties."""
    picks = [
        fact_row(product_id=p, section=s, origin=o, order=f"{i % 4}", group=g, volume=v, when=w)
        for i, (p, s, o, g, v, w) in enumerate(
            (p, s, o, g, v, w)
            for p, g in (("1", "G1"), ("2", None), (None, "G2"))
            for s in ("A", None)
            for o in (46, None)
            for v, w in ((3, "2018-01-30 10:00:00"), (2, "2018-01-30 11:30:00"), (7, "2018-02-02 00:00:00"), (1, "2020-01-01 05:00:00"))
        )
    ]
    errors = [
        fact_row(section=s, origin=o, group=g, volume=0, when=w)
        for s, o, g in (("A", 46, "G1"), (None, 46, "G9"), ("B", None, None))
        for w in ("2018-01-30 10:00:00", "2018-01-31 10:00:00", "2021-01-01 00:00:00")
    ]
    days = calendar(spark, *[f"2018-01-{d}" for d in (29, 30, 31)], "2018-02-02")
    return Facts(facts(spark, picks), facts(spark, errors), days)


@pytest.mark.parametrize("name", sorted(SINGLE))
def test_members_are_the_single_marts(odd, name):
    stacked = FAMILIES[name](odd, families.ALL_MEMBERS).cache()
    total = 0
    for g in families.ALL_MEMBERS:
        want = SINGLE[name](odd, g)
        got = families.member(stacked, g)
        assert got.columns == want.columns
        assert got.dtypes == want.dtypes
        assert rows_of(got) == rows_of(want), g
        total += got.count()
    assert stacked.count() == total
    stacked.unpersist()


@pytest.mark.parametrize("members", [(None,), ("origin",), ("warehouse_section", None), ("origin", "product_group")])
def test_some_members_only(odd, members):
    stacked = families.pick_volume_family(odd.f_order_picks, odd.d_date, members)
    for g in members:
        assert rows_of(families.member(stacked, g)) == rows_of(total_pick_volume(odd.f_order_picks, odd.d_date, g))
    assert {r["drill_down"] for r in stacked.collect()} == {g or "none" for g in members}


def test_empty_facts(odd):
    none = Facts(odd.f_order_picks.where("false"), odd.f_pick_errors.where("false"), odd.d_date)
    for name, build in FAMILIES.items():
        rows = build(none, families.ALL_MEMBERS).collect()
        assert len(rows) == (4 * 4 if name == "total_orders_processed" else 0)  # every day, no orders


def test_members_must_be_different_and_known(odd):
    for bad in ((), (None, None), ("origin", "origin"), ("week",)):
        with pytest.raises(ValueError):
            families.pick_volume_family(odd.f_order_picks, odd.d_date, bad)


@pytest.mark.parametrize("name", sorted(SINGLE))
def test_one_scan_and_one_expand(spark, name):
    df = all_queries()[f"family_{name}"](spark, SMOKE_DIR)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\bExpand\b", plan)) == 1
    assert len(re.findall(r"Relation \[l_orderkey", plan)) == 1, plan
    assert "Join Cross" not in plan


def test_full_run_writes_each_family_once(spark, tmp_path):
    base = str(tmp_path)
    stage_driver_tables(spark, SMOKE_DIR, base)
    full_run.run_curation(spark, base, "1995-07-01", "2001-06-30")
    names = [s.name for s in MARTS.values() if s.member_of == "total_pick_volume"] + ["pick_errors", "pick_errors_origin"]
    full_run.run_marts(spark, base, names, bucket_table="t_families")
    stacked = os.path.join(base, "data_mart", "_families")
    assert sorted(os.listdir(stacked)) == ["pick_errors", "total_pick_volume"]
    assert sorted(x for x in os.listdir(os.path.join(stacked, "pick_errors")) if "=" in x) == ["drill_down=none", "drill_down=origin"]
    for name in names:
        spec = MARTS[name]
        got = spark.read.parquet(os.path.join(base, "data_mart", spec.family, spec.table))
        want = all_queries()[name](spark, SMOKE_DIR)
        assert got.columns == want.columns and rows_of(got) == rows_of(want)
    assert os.path.isdir(os.path.join(base, "curation", "d_warehouse_section"))  # the section list is not empty


def test_buckets_follow_the_size_of_the_facts(spark, tmp_path):
    base = str(tmp_path)
    stage_driver_tables(spark, SMOKE_DIR, base)
    full_run.run_curation(spark, base, "1995-07-01", "2001-06-30")
    limit = 16 << 10
    buckets = full_run.order_buckets(spark, base, limit, least=1)
    assert buckets > 4 and full_run.order_buckets(spark, base) == full_run.LEAST_BUCKETS
    try:
        full_run.build_mart_inputs(spark, base, {"order_days"}, bucket_table="t_sized", buckets=buckets)
        folder = os.path.join(base, "data_mart", "_inputs", "order_days")
        sizes = [os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder) if f.endswith(".parquet")]
        assert len(sizes) == buckets and max(sizes) <= limit
    finally:
        spark.sql("DROP TABLE IF EXISTS t_sized")


def test_products_are_counted_by_member_where_they_were_dealt(spark):
    """Facts dealt by product are shuffled twice: the counts of all members, and the best of each task."""
    rows = [fact_row(product_id=f"{k % 40:06d}", group=f"G{k % 3}" if k % 7 else None) for k in range(400)]
    dealt = facts(spark, rows).repartition(5, "product_id")
    family = families.top_products_family(dealt, calendar(spark, "2018-01-30"))
    plan = family._jdf.queryExecution().executedPlan().toString()
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "ENSURE_REQUIREMENTS" in x]
    assert len(shuffles) == 2, plan
    for g in (None, "product_group", "origin", "warehouse_section"):
        assert rows_of(families.member(family, g)) == rows_of(top_n_products_weekly(dealt, calendar(spark, "2018-01-30"), g))


@pytest.mark.parametrize("name", ["top_n_products_weekly_product_group", "family_top_n_products_weekly"])
def test_a_task_counts_products_of_a_bounded_number_of_lines(spark, monkeypatch, name):
    """The partitions follow the rows, not the session's setting; the rows stay."""
    from pickmarts.plans import driver_queries

    run = driver_queries.all_queries()[name]
    whole = rows_of(run(spark, SMOKE_DIR))
    lines = spark.read.parquet(f"{SMOKE_DIR}/lineitem.parquet").count()
    monkeypatch.setattr(driver_queries, "DEALT_ROWS", lines // 20)
    df = run(spark, SMOKE_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.splitlines() if "REPARTITION_BY_NUM" in x]
    assert len(dealt) == 1 and f", {-(-lines // (lines // 20))})" in dealt[0], plan
    assert rows_of(df) == whole
