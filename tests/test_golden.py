"""The original test suite's twelve golden results, on our own fixture rows.

Fixture: one customer order (origin 48) of one product group picked on one day
(37 picks: 8 in one section summing to 176, 29 in another summing to 92) and six pick
errors spread over two origins, four product groups and three sections; the
calendar holds that one day.
"""

from __future__ import annotations

import datetime as dt

import pytest

from conftest import calendar, fact_row, facts, rows_of
from pickmarts.operators import pick_errors, total_orders_processed, total_pick_volume

DAY = dt.date(2018, 1, 30)
CAL = ("2018_05", "2018_01", "2018_Q1", "2018_H1", 2018)

# Invented product groups.
LAMPS = "lamps"
FIXINGS = "fixings"
CABLES = "cables"
NETWORK = "network"
CABINETS = "cabinets"


@pytest.fixture(scope="module")
def golden(spark):
    picks = []
    for i in range(8):
        picks.append(fact_row(section="bay", order="70000001", volume=22, when=f"2018-01-30 10:{i:02d}:00",
                              seq=i + 1, group=LAMPS))
    for i in range(29):
        picks.append(fact_row(section="aisle", order="70000001", volume=8 if i == 0 else 3,
                              when=f"2018-01-30 12:{i:02d}:00", seq=9 + i, group=LAMPS))
    errors = [
        fact_row(section="aisle", origin=48, order="70000002", volume=0, group=FIXINGS),
        fact_row(section="aisle", origin=46, order="70000003", volume=0, group=CABLES),
        fact_row(section="cart", origin=48, order="70000004", volume=0, group=FIXINGS),
        fact_row(section="aisle", origin=48, order="70000005", volume=0, group=FIXINGS),
        fact_row(section="aisle", origin=46, order="70000006", volume=0, group=NETWORK),
        fact_row(section="bay", origin=48, order="70000007", volume=0, group=CABINETS),
    ]
    return facts(spark, picks), facts(spark, errors), calendar(spark, "2018-01-30")


def test_total_pick_volume(golden):
    f, _, d = golden
    assert rows_of(total_pick_volume(f, d)) == [(DAY, 268, *CAL)]


@pytest.mark.parametrize(
    "g,want",
    [("origin", [(48, 268)]), ("product_group", [(LAMPS, 268)]), ("warehouse_section", [("aisle", 92), ("bay", 176)])],
)
def test_total_pick_volume_drill_down(golden, g, want):
    f, _, d = golden
    assert rows_of(total_pick_volume(f, d, g)) == [(DAY, gv, v, *CAL) for gv, v in want]


def test_total_orders_processed(golden):
    f, _, d = golden
    assert rows_of(total_orders_processed(f, d)) == [(DAY, 1, *CAL)]


@pytest.mark.parametrize(
    "g,want",
    [("origin", [48]), ("product_group", [LAMPS]), ("warehouse_section", ["aisle", "bay"])],
)
def test_total_orders_processed_drill_down(golden, g, want):
    f, _, d = golden
    assert rows_of(total_orders_processed(f, d, g)) == [(DAY, gv, 1, *CAL) for gv in want]


def test_pick_errors(golden):
    f, e, d = golden
    assert rows_of(pick_errors(f, e, d)) == [(DAY, "2018_05", "2018_01", 6, 37)]


@pytest.mark.parametrize(
    "g,want",
    [
        ("origin", [(46, 2, None), (48, 4, 37)]),
        ("product_group", [(FIXINGS, 3, None), (CABINETS, 1, None), (CABLES, 1, None), (NETWORK, 1, None)]),
        ("warehouse_section", [("aisle", 4, 29), ("bay", 1, 8), ("cart", 1, None)]),
    ],
)
def test_pick_errors_drill_down(golden, g, want):
    f, e, d = golden
    got = rows_of(pick_errors(f, e, d, g))
    assert got == rows_of_expected([(DAY, "2018_05", "2018_01", gv, n, p) for gv, n, p in want])


def rows_of_expected(rows):
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))
