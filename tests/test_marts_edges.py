"""Hand-made edge rows for every mart family (cases of FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt
import math

import pytest

from conftest import calendar, fact_row, facts, rows_of, srt
from pickmarts.operators import (
    avg_products_picked_per_order,
    binned_order_volume,
    order_count_by_type,
    order_mix,
    pick_errors,
    pick_throughput_hourly,
    pick_throughput_weekly,
    top_n_products_weekly,
    total_orders_processed,
    total_pick_volume,
    warehouse_utilization_per_section,
    weekly_zscore_distribution,
    zscore_outliers,
)

D29, D30, F05, F12, F19 = "2018-01-29", "2018-01-30", "2018-02-05", "2018-02-12", "2018-02-19"


def d(s):
    return dt.date.fromisoformat(s)


@pytest.fixture(scope="module")
def cal(spark):
    # weeks: 29th/30th -> 2018_05, Feb 5 -> 2018_06, Feb 12 -> 2018_07, Feb 19 -> 2018_08
    return calendar(spark, D29, D30, F05, F12, F19)


def test_volume_and_orders_calendar_direction(spark, cal):
    f = facts(spark, [
        fact_row(order="1", volume=5, when=f"{D30} 10:00:00", section="HRL"),
        fact_row(order="2", volume=1, when=f"{D30} 11:00:00", section="AKL"),
        fact_row(order="3", volume=3, when="2017-12-31 10:00:00"),
        fact_row(order="4", volume=4, when="2018-03-01 10:00:00"),
        fact_row(order="5", volume=6, when="2018-03-01 12:00:00"),
    ])
    vol = rows_of(total_pick_volume(f, cal), ["date", "pick_volume", "week"])
    # Pick days outside the calendar stay, with NULL calendar columns.
    assert vol == srt([(d(D30), 6, "2018_05"), (None, 10, None), (None, 3, None)])
    orders = rows_of(total_orders_processed(f, cal), ["date", "order_volume"])
    assert orders == srt([(d(D29), 0), (d(D30), 2), (d(F05), 0), (d(F12), 0), (d(F19), 0)])
    by_section = rows_of(total_orders_processed(f, cal, "warehouse_section"), ["date", "warehouse_section", "order_volume"])
    assert by_section == srt([
        (d(D29), None, 0), (d(D30), "AKL", 1), (d(D30), "HRL", 1), (d(F05), None, 0), (d(F12), None, 0), (d(F19), None, 0)
    ])


def test_pick_errors_null_keys_never_match(spark, cal):
    f = facts(spark, [fact_row(order="1", volume=5, when=f"{D30} 10:00:00"),
                      fact_row(order="2", volume=5, when="2017-12-31 10:00:00"),
                      fact_row(order="3", volume=5, when=f"{D30} 11:00:00", group=None)])
    e = facts(spark, [fact_row(order="9", volume=0, when=f"{D30} 09:00:00"),
                      fact_row(order="8", volume=0, when="2017-12-31 09:00:00"),
                      fact_row(order="7", volume=0, when=f"{D30} 09:30:00", group=None)])
    assert rows_of(pick_errors(f, e, cal)) == srt([(d(D30), "2018_05", "2018_01", 2, 2), (None, None, None, 1, None)])
    by_group = rows_of(pick_errors(f, e, cal, "product_group"))
    assert by_group == srt([
        (d(D30), "2018_05", "2018_01", "G1", 1, 1),
        (d(D30), "2018_05", "2018_01", None, 1, None),  # NULL group: no match
        (None, None, None, "G1", 1, None),
    ])


def test_top_n_ties_broken_by_product(spark, cal):
    rows = []
    for product, n in [("P1", 3), ("P4", 2), ("P3", 2), ("P2", 2), ("P5", 1)]:
        rows += [fact_row(product_id=product, volume=1, when=f"{D30} 10:00:0{i}") for i in range(n)]
    f = facts(spark, rows)
    got = rows_of(top_n_products_weekly(f, cal, n=3))
    assert got == srt([("2018_05", "P1", 3), ("2018_05", "P2", 2), ("2018_05", "P3", 2)])
    assert len(rows_of(top_n_products_weekly(f, cal))) == 5


def test_throughput_hourly_and_weekly(spark, cal):
    f = facts(spark, [
        fact_row(volume=5, when=f"{D30} 10:00:00"),
        fact_row(volume=3, when=f"{D30} 10:30:00"),
        fact_row(volume=4, when=f"{D29} 11:00:00", origin=46),
    ])
    assert rows_of(pick_throughput_hourly(f)) == srt([(d(D29), 11, 4), (d(D30), 10, 8)])
    assert rows_of(pick_throughput_weekly(f, cal)) == srt([("2018_05", 6.0)])
    assert rows_of(pick_throughput_weekly(f, cal, "origin")) == srt([("2018_05", 46, 4.0), ("2018_05", 48, 8.0)])


def test_order_mix_and_products_per_order(spark, cal):
    f = facts(spark, [
        fact_row(product_id="P1", order="1", section="HRL", volume=20, when=f"{D30} 10:00:00"),
        fact_row(product_id="P2", order="1", section="HRL", volume=10, when=f"{D30} 11:00:00"),
        fact_row(product_id="P1", order="1", section="AKL", volume=10, when=f"{D29} 09:00:00"),
        fact_row(product_id="P3", order="2", section="AKL", volume=57, when=f"{F05} 09:00:00"),
        fact_row(product_id="P3", order="2", section="HRL", volume=743, when=f"{F05} 10:00:00"),
        fact_row(product_id="P3", order=None, section="HRL", volume=5, when=f"{F05} 10:00:00"),
    ])
    mix = rows_of(order_mix(f))
    assert mix == srt([
        (d(F05), "2_2018", "AKL", 7.12),  # 57/800, rounded on the binary double
        (d(F05), "2_2018", "HRL", 92.88),
        (d(D29), "1_2018", "AKL", 25.0),
        (d(D29), "1_2018", "HRL", 75.0),
        (None, None, "HRL", None),  # NULL order matches no order total
    ])
    avg = rows_of(avg_products_picked_per_order(f, cal))
    assert avg == srt([("2018_05", 2.0), ("2018_06", 1.0)])


def test_order_count_by_type(spark, cal):
    f = facts(spark, [
        fact_row(order="1", origin=48, when=f"{D30} 10:00:00"),
        fact_row(order="2", origin=48, when=f"{D29} 10:00:00"),
        fact_row(order="3", origin=46, when=f"{D30} 10:00:00"),
        fact_row(order="4", origin=48, when=f"{F05} 10:00:00"),   # week with 48 only
        fact_row(order="7", origin=46, when=f"{F12} 10:00:00"),   # week with 46 only
        fact_row(order="8", origin=47, when=f"{F19} 10:00:00"),   # other origin only: no row
        fact_row(order="5", origin=48, when="2017-12-31 10:00:00"),  # NULL week, both sides
        fact_row(order="6", origin=46, when="2017-12-30 10:00:00"),
    ])
    got = rows_of(order_count_by_type(f, cal))
    assert got == srt([
        ("2018_05", 2, 1, 3, 66.67, 33.33, 0.5, 2.0),
        ("2018_06", 1, 0, None, None, None, 0.0, 0.0),
        ("2018_07", 0, 1, None, None, None, 0.0, 0.0),
        (None, 0, 1, None, None, None, 0.0, 0.0),
        (None, 1, 0, None, None, None, 0.0, 0.0),
    ])


def test_warehouse_utilization_null_week_row(spark, cal):
    f = facts(spark, [
        fact_row(section="HRL", volume=30, when=f"{D30} 10:00:00"),
        fact_row(section="AKL", volume=10, when=f"{D29} 10:00:00"),
        fact_row(section="AKL", volume=3, when="2017-12-31 10:00:00"),
        fact_row(section="HRL", volume=3, when="2017-12-31 11:00:00"),
    ])
    got = rows_of(warehouse_utilization_per_section(cal, f))
    assert got == srt([("2018_05", "AKL", 25.0), ("2018_05", "HRL", 75.0), (None, None, 0.0)])


def test_binned_order_volume_grid(spark):
    cal2 = calendar(spark, D29, D30)
    f = facts(spark, [
        fact_row(order="1", volume=40, when=f"{D30} 10:00:00"),
        fact_row(order="2", volume=60, when=f"{D30} 10:00:00"),
        fact_row(order="1", volume=200, when=f"{D29} 10:00:00"),   # same order, other day
        fact_row(order="3", volume=250000, when=f"{D30} 10:00:00"),  # beyond the last bin
        fact_row(order="4", volume=5, when="2017-12-31 10:00:00"),  # outside the calendar
    ])
    got = binned_order_volume(f, cal2)
    assert got.count() == 12
    nonzero = rows_of(got.filter("order_volume > 0"), ["date", "bins", "order_volume"])
    assert nonzero == srt([(d(D29), "medium", 1), (d(D30), "mini", 1), (d(D30), "small", 1)])


def test_zscores(spark, cal):
    f = facts(spark, [
        fact_row(order="1", volume=10, when=f"{D30} 10:00:00"),
        fact_row(order="2", volume=30, when=f"{D29} 10:00:00"),
        fact_row(order="3", volume=7, when=f"{F05} 10:00:00"),    # single order: std -> 1
        fact_row(order="4", volume=5, when=f"{F12} 10:00:00"),    # two equal orders: std 0
        fact_row(order="5", volume=5, when=f"{F12} 11:00:00"),
        fact_row(order="6", volume=5, when="2017-12-31 10:00:00"),  # NULL week
    ])
    z = {r["sk_order_id"]: r["zscore"] for r in weekly_zscore_distribution(f, cal).collect()}
    assert math.isclose(z["1_2018"], -1 / math.sqrt(2)) and math.isclose(z["2_2018"], 1 / math.sqrt(2))
    assert z["3_2018"] == 0.0
    assert z["4_2018"] is None and z["5_2018"] is None
    assert z["6_2017"] is None
    by_month = weekly_zscore_distribution(f, cal, "month")
    assert by_month.columns == ["sk_order_id", "month", "pick_volume", "zscore"]
    assert zscore_outliers(weekly_zscore_distribution(f, cal)).count() == 0


def test_zscore_outliers_filter(spark):
    df = spark.createDataFrame([("a", 3.5), ("b", -4.0), ("c", 3.0), ("d", None)], "sk_order_id string, zscore double")
    assert sorted(r[0] for r in zscore_outliers(df).collect()) == ["a", "b"]


def test_drill_down_allow_list(spark, cal):
    f = facts(spark, [fact_row()])
    with pytest.raises(ValueError):
        total_pick_volume(f, cal, "description")
    with pytest.raises(ValueError):
        weekly_zscore_distribution(f, cal, "pick_volume")


@pytest.mark.parametrize("tz", ["Europe/Berlin", "Asia/Kolkata"])
def test_hourly_input_is_zone_independent(spark, tz):
    from pickmarts.operators.mart_inputs import hourly_volume

    f = facts(spark, [
        fact_row(volume=5, when="2018-03-25 02:30:00"),  # inside Berlin's daylight-saving gap
        fact_row(volume=7, when="2018-10-28 02:15:00"),
        fact_row(volume=1, when="2018-01-30 23:59:59"),
    ])
    products = spark.createDataFrame([], "product_id string, product_group string")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        assert rows_of(pick_throughput_hourly(hourly_volume(f, products))) == rows_of(pick_throughput_hourly(f))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
