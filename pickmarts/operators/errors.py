"""Pick errors per day, next to the number of picks that day.

Errors and picks are counted together per (pick day[, g]), then the days are
looked up in the calendar and the counts added by (date, week, month[, g]); a
pick day outside the calendar counts under NULL keys. Only groups with errors
are reported. ``total_picks`` is NULL for a day or value without any picks, and
also where a key is NULL (days outside the calendar, NULL drill-down values):
such errors never find their picks.

The counts are combined map-side; everything after them is bounded by (days x
drill-down values). ``pick_errors_of_picks`` reads picks and errors in one scan
of the keyed picks; ``pick_errors`` takes separately stored facts.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickmarts.operators.common import drill_keys, row_count, with_calendar, with_rows

_KEYS = ("date", "week", "month")


def _reported(daily: DataFrame, d_date: DataFrame, g: list[str]) -> DataFrame:
    """The mart from (pick_date, [g], errors, picks) rows, several per day allowed."""
    keys = [*_KEYS, *g]
    totals = with_calendar(daily, d_date, "pick_date", "week", "month").groupBy(*keys)
    totals = totals.agg(F.sum("errors").alias("total_errors"), F.sum("picks").alias("picks"))
    unmatched = reduce(or_, [F.col(k).isNull() for k in keys]) | (F.col("picks") == 0)
    return totals.where("total_errors > 0").select(
        *keys, "total_errors", F.when(~unmatched, F.col("picks")).alias("total_picks")
    )


def _counted(fact: DataFrame, g: list[str], errors: bool) -> DataFrame:
    rows = with_rows(fact, "pick_date", *g)
    n: Column = row_count(rows).cast("bigint")
    none = F.lit(0).cast("bigint")
    return rows.groupBy("pick_date", *g).agg((n if errors else none).alias("errors"), (none if errors else n).alias("picks"))


def pick_errors(
    f_order_picks: DataFrame,
    f_pick_errors: DataFrame,
    d_date: DataFrame,
    drill_down: str | None = None,
) -> DataFrame:
    """M09 (no drill-down) and M10-M12."""
    g = drill_keys(drill_down)
    daily = _counted(f_pick_errors, g, errors=True).unionByName(_counted(f_order_picks, g, errors=False))
    return _reported(daily, d_date, g)


def pick_errors_of_picks(picks: DataFrame, d_date: DataFrame, drill_down: str | None = None) -> DataFrame:
    """The same mart from picks of all signs, read once."""
    g = drill_keys(drill_down)
    daily = picks.where("pick_volume >= 0").groupBy("pick_date", *g)
    daily = daily.agg(
        F.count_if(F.col("pick_volume") == 0).alias("errors"), F.count_if(F.col("pick_volume") > 0).alias("picks")
    )
    return _reported(daily, d_date, g)
