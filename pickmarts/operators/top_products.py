"""The n most picked products of each week [and drill-down value].

Picks are counted per (day, product[, g]), the days looked up in the calendar
and the counts added per week; a product's rank inside its week
is a ``row_number`` by count descending, ties broken by product id so the
result is repeatable. The rank filter lets Catalyst insert a partial
``WindowGroupLimit`` before the shuffle: each task sends at most n rows per
week onward, so a week with most of the picks costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickmarts.operators.common import drill_keys, row_count, with_calendar, with_rows

DEFAULT_TOP_N = 10


def top_n_products_weekly(
    f_order_picks: DataFrame,
    d_date: DataFrame,
    drill_down: str | None = None,
    n: int = DEFAULT_TOP_N,
) -> DataFrame:
    """M13 (no drill-down) and M14-M16: week, product_id, [g], total_picks."""
    if int(n) < 1:
        raise ValueError("n must be at least 1")
    g = drill_keys(drill_down)
    picks = with_rows(f_order_picks, "pick_date", "product_id", *g)
    daily = picks.groupBy("pick_date", "product_id", *g).agg(row_count(picks).cast("bigint").alias("picks"))
    counts = with_calendar(daily, d_date, "pick_date", "week").groupBy("week", "product_id", *g)
    counts = counts.agg(F.sum("picks").alias("total_picks"))
    w = Window.partitionBy("week", *g).orderBy(F.col("total_picks").desc(), F.col("product_id").asc_nulls_last())
    return (
        counts.withColumn("_rank", F.row_number().over(w))
        .filter(F.col("_rank") <= F.lit(int(n)))
        .select("week", "product_id", *g, "total_picks")
    )
