"""Calendar label columns (year, week, month, quarter, half-year).

The week label is the ``%Y_%W`` convention: weeks start on Monday and the
days of January before the first Monday belong to week 00. It is *not* the
ISO week, so Spark's ``weekofyear`` must not be used.

Each label is defined once as SQL text over a column name (``*_sql``) and
handed to the JVM as one expression; the ``*_label`` helpers wrap that text
as a Column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_label_sql(d: str) -> str:
    return f"CAST(year({d}) AS STRING)"


def week_label_sql(d: str) -> str:
    """``YYYY_WW``: weekday() is Monday = 0 ... Sunday = 6."""
    week = f"floor((dayofyear({d}) + 6 - weekday({d})) / 7)"
    return f"concat({year_label_sql(d)}, '_', lpad(CAST({week} AS STRING), 2, '0'))"


def month_label_sql(d: str) -> str:
    return f"date_format({d}, 'yyyy_MM')"


def quarter_label_sql(d: str) -> str:
    return f"concat({year_label_sql(d)}, '_Q', CAST(quarter({d}) AS STRING))"


def year_half_label_sql(d: str) -> str:
    return f"concat({year_label_sql(d)}, '_H', CAST(floor((quarter({d}) + 1) / 2) AS STRING))"


def year_label(d: str) -> Column:
    return F.expr(year_label_sql(d))


def week_label(d: str) -> Column:
    return F.expr(week_label_sql(d))


def month_label(d: str) -> Column:
    return F.expr(month_label_sql(d))


def quarter_label(d: str) -> Column:
    return F.expr(quarter_label_sql(d))


def year_half_label(d: str) -> Column:
    return F.expr(year_half_label_sql(d))
