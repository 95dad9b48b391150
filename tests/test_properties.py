"""Properties that must hold on any data (checked on the driver's sf0.001 tables)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from pickmarts.operators import curation as cur
from pickmarts.operators.calendar_dim import calendar_days
from pickmarts.plans.driver_queries import adapter_calendar, all_queries, keyed_picks
from pickmarts.sources.tpch_adapter import ADAPTER_CALENDAR_END, ADAPTER_CALENDAR_START


@pytest.fixture(scope="module")
def q():
    return all_queries()


def _total(df, col):
    return df.agg(F.sum(col)).collect()[0][0]


def test_sign_split_partitions_the_picks(spark, q):
    keyed = keyed_picks(spark, SMOKE_DIR, with_positions=True)
    n = keyed.count()
    parts = [q[name](spark, SMOKE_DIR).count() for name in ("f_order_picks", "f_pick_errors", "f_returns")]
    assert sum(parts) == n == q["staged_pick_data"](spark, SMOKE_DIR).count()


def test_drill_downs_add_up(spark, q):
    base = _total(q["total_pick_volume"](spark, SMOKE_DIR), "pick_volume")
    for g in ("product_group", "origin", "warehouse_section"):
        assert _total(q[f"total_pick_volume_{g}"](spark, SMOKE_DIR), "pick_volume") == base
    errors = _total(q["pick_errors"](spark, SMOKE_DIR), "total_errors")
    for g in ("product_group", "origin", "warehouse_section"):
        assert _total(q[f"pick_errors_{g}"](spark, SMOKE_DIR), "total_errors") == errors


def test_order_mix_sections_sum_to_100(spark, q):
    mix = q["order_mix"](spark, SMOKE_DIR)
    per_order = mix.groupBy("sk_order_id").agg(
        F.sum("section_pick_percentage").alias("s"), F.count(F.lit(1)).alias("n")
    )
    bad = per_order.filter(F.abs(F.col("s") - 100.0) > F.col("n") * 0.01 + 1e-9)
    assert bad.isEmpty()


def test_binned_grid_is_dense(spark, q):
    got = q["binned_order_volume"](spark, SMOKE_DIR)
    assert got.count() == calendar_days(ADAPTER_CALENDAR_START, ADAPTER_CALENDAR_END) * 6
    picks = cur.order_picks_fact(keyed_picks(spark, SMOKE_DIR, with_positions=False))
    cal = adapter_calendar(spark).select("date")
    in_cal = picks.join(cal, picks["pick_date"] == cal["date"], "left_semi")
    orders_days = in_cal.select("pick_date", "sk_order_id").distinct().count()
    assert _total(got, "order_volume") == orders_days  # every order-day has a bin here


def test_positions_are_dense_per_order(spark, q):
    pos = q["sk_position_in_order"](spark, SMOKE_DIR)
    per = pos.groupBy("sk_order_id", "origin").agg(
        F.count(F.lit(1)).alias("n"), F.max("sk_position_in_order").alias("mx"),
        F.countDistinct("sk_position_in_order").alias("d"),
    )
    assert per.filter((F.col("n") != F.col("mx")) | (F.col("n") != F.col("d"))).isEmpty()


def test_top_n_at_most_ten_per_week(spark, q):
    top = q["top_n_products_weekly"](spark, SMOKE_DIR)
    assert top.groupBy("week").count().filter(F.col("count") > 10).isEmpty()
