"""Weekly share of each warehouse section in the week's pick volume.

The facts are added up per (day, section) first; the calendar lookup, the
weekly aggregate and the window total over the week see at most (days x
sections) rows.

Out-of-calendar picks (NULL week) never match a week total in the original
definition, so they give exactly one row (NULL, NULL, 0.0); the aggregate
already folds all their sections into that one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickmarts.functions.numeric import share_percent
from pickmarts.operators.common import with_calendar


def warehouse_utilization_per_section(d_date: DataFrame, f_order_picks: DataFrame) -> DataFrame:
    """week, warehouse_section, section_utilization. Argument order as in the original."""
    daily = f_order_picks.groupBy("pick_date", "warehouse_section").agg(F.sum("pick_volume").alias("pick_volume"))
    j = with_calendar(daily, d_date, "pick_date", "week")
    in_calendar = F.col("week").isNotNull()
    per_section = j.groupBy(
        "week", F.when(in_calendar, F.col("warehouse_section")).alias("warehouse_section")
    ).agg(F.sum("pick_volume").alias("section_volume"))
    week_total = F.sum("section_volume").over(Window.partitionBy("week"))
    return per_section.select(
        "week",
        "warehouse_section",
        F.when(in_calendar, share_percent(F.coalesce(F.col("section_volume"), F.lit(0)), week_total))
        .otherwise(F.lit(0.0))
        .alias("section_utilization"),
    )
