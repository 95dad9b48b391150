"""The calendar dimension ``d_date``, one row per day, both ends included.

Columns: date, year, week (``YYYY_WW``, Monday-first, week 00 before the first
Monday), month (``YYYY_MM``), quarter (``YYYY_Qn``), year_half (``YYYY_Hn``).

The table is generated with ``spark.range`` (no driver-side list, no giant
array). Marts look it up after their first aggregation and leave the join
strategy to the optimizer, so a calendar of any length will do.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from pickmarts.functions.calendar import month_label_sql, quarter_label_sql, week_label_sql, year_half_label_sql

# Calendar range of the original full run.
DEFAULT_START = "2011-06-01"
DEFAULT_END = "2020-07-15"


def calendar_days(start: str, end: str) -> int:
    """Number of rows of ``create_d_date(start, end)``."""
    d0, d1 = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    return max((d1 - d0).days + 1, 0)


def create_d_date(spark: SparkSession, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    n = calendar_days(start, end)
    first = dt.date.fromisoformat(start).isoformat()  # normalised: safe as a SQL literal
    return (
        spark.range(0, n, 1, numPartitions=1)
        .selectExpr(f"date_add(DATE '{first}', CAST(id AS INT)) AS date")
        .selectExpr(
            "date",
            "CAST(year(date) AS INT) AS year",
            f"{week_label_sql('date')} AS week",
            f"{month_label_sql('date')} AS month",
            f"{quarter_label_sql('date')} AS quarter",
            f"{year_half_label_sql('date')} AS year_half",
        )
    )

