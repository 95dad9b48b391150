"""Daily pick volume and daily distinct orders, with drill-downs.

Both aggregate by pick day *before* touching the calendar, so the calendar
join works on at most (days x drill-down values) rows.

The two families deliberately differ in join direction:

* pick volume keeps every pick day, also days outside the calendar (their
  calendar columns, ``date`` included, are NULL);
* orders processed keeps every calendar day (0 orders when nothing was
  picked; such a day is one row with a NULL drill-down value) and drops pick
  days outside the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickmarts.operators.common import drill_keys
from pickmarts.schemas import CALENDAR_LABELS


def total_pick_volume(f_order_picks: DataFrame, d_date: DataFrame, drill_down: str | None = None) -> DataFrame:
    """M01 (no drill-down) and M02-M04: sum of pick_volume by day [and g]."""
    g = drill_keys(drill_down)
    daily = f_order_picks.groupBy("pick_date", *g).agg(F.sum("pick_volume").alias("pick_volume"))
    cal = d_date.select("date", *CALENDAR_LABELS)
    joined = daily.join(cal, daily["pick_date"] == cal["date"], "left")
    return joined.select(
        cal["date"],
        *g,
        F.coalesce(F.col("pick_volume"), F.lit(0).cast("bigint")).alias("pick_volume"),
        *CALENDAR_LABELS,
    )


def total_orders_processed(
    f_order_picks: DataFrame, d_date: DataFrame, drill_down: str | None = None
) -> DataFrame:
    """M05 (no drill-down) and M06-M08: distinct orders by calendar day [and g].

    ``count_distinct`` runs as a two-level aggregate (day, g, order) then
    (day, g), so a busy day is spread over many tasks.
    """
    g = drill_keys(drill_down)
    daily = f_order_picks.groupBy("pick_date", *g).agg(F.count_distinct("sk_order_id").alias("order_volume"))
    cal = d_date.select("date", *CALENDAR_LABELS)
    # The calendar is the preserved side, so it cannot be the broadcast side;
    # the daily aggregate (bounded by days x g values) is, when small enough.
    joined = cal.join(daily, cal["date"] == daily["pick_date"], "left")
    return joined.select(
        cal["date"],
        *g,
        F.coalesce(F.col("order_volume"), F.lit(0).cast("bigint")).alias("order_volume"),
        *CALENDAR_LABELS,
    )
