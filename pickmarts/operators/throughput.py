"""Pick throughput.

* M17 ``pick_throughput_hourly``: pick volume per (day, hour of day) - the
  table the original base job actually returned.
* M17b / M18-M20 ``pick_throughput_weekly``: the mean of those hourly sums
  over the hours of a week that had picks, rounded to 2 digits, per week
  [and drill-down value].

Both are two-level aggregates: the hourly level shrinks the facts to at most
24 rows per day (and value) before the calendar lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickmarts.functions.numeric import half_up
from pickmarts.operators.common import drill_keys, with_calendar


def _hourly(f_order_picks: DataFrame, g: list[str]) -> DataFrame:
    return f_order_picks.groupBy(
        "pick_date", F.hour("pick_timestamp").cast("int").alias("pick_hour"), *g
    ).agg(F.sum("pick_volume").alias("pick_volume"))


def pick_throughput_hourly(f_order_picks: DataFrame) -> DataFrame:
    """pick_date, pick_hour, pick_volume."""
    return _hourly(f_order_picks, []).select("pick_date", "pick_hour", "pick_volume")


def pick_throughput_weekly(
    f_order_picks: DataFrame, d_date: DataFrame, drill_down: str | None = None
) -> DataFrame:
    """M17b (no drill-down) and M18-M20: week, [g], weekly_pick_throughput_avg."""
    g = drill_keys(drill_down)
    hourly = with_calendar(_hourly(f_order_picks, g), d_date, "pick_date", "week")
    return hourly.groupBy("week", *g).agg(
        half_up(F.avg("pick_volume"), 2).alias("weekly_pick_throughput_avg")
    )
