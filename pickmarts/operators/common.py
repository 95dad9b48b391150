"""Shared pieces of the mart jobs: drill-down allow-list, calendar lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The drill-down dimensions of every mart family.
DRILL_DOWNS = ("product_group", "origin", "warehouse_section")

# Calendar columns that may serve as a period (z-score grouping).
PERIODS = ("date", "year", "week", "month", "quarter", "year_half")


def drill_keys(drill_down: str | None) -> list[str]:
    """``[drill_down]`` after checking it against the allow-list."""
    if drill_down is None:
        return []
    if drill_down not in DRILL_DOWNS:
        raise ValueError(f"drill_down must be one of {DRILL_DOWNS}, got {drill_down!r}")
    return [drill_down]


def check_period(period: str) -> str:
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}, got {period!r}")
    return period


def with_calendar(df: DataFrame, d_date: DataFrame, on: str, *cols: str) -> DataFrame:
    """``df`` left-joined to the calendar on ``df[on] = d_date.date``.

    The calendar ``date`` column comes along as ``date`` (NULL when the day is
    outside the calendar). Additive marts call it on their daily aggregate, not
    on the facts; the optimizer picks the join by measured size.
    """
    cal = d_date.select("date", *cols)
    return df.join(cal, df[on] == cal["date"], "left")


# Rows of a pre-aggregated input may stand for several fact rows; this column
# holds how many. Marts count fact rows with ``row_count``, so they give the
# same result on raw facts and on such inputs.
ROWS = "_rows"


def row_count(df: DataFrame):
    """``count(*)`` of the fact rows behind ``df``."""
    return F.sum(ROWS) if ROWS in df.columns else F.count(F.lit(1))


def with_rows(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` projected to ``cols`` plus the row weight when it has one."""
    return df.select(*cols, *([ROWS] if ROWS in df.columns else []))
