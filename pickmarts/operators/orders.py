"""Order-level marts M21-M23.

* M21 ``order_mix``: share of each warehouse section in an order's volume.
* M22 ``avg_products_picked_per_order``: distinct products per order,
  averaged by the week of the order's first pick day.
* M23 ``order_count_by_type``: weekly distinct orders of origin 48 (customer)
  and 46 (store), their shares and ratios.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickmarts.functions.numeric import half_up, share_percent
from pickmarts.operators.common import with_calendar

# Order origins (46 = store order, 48 = customer order).
STORE_ORIGIN = 46
CUSTOMER_ORIGIN = 48


def order_mix(f_order_picks: DataFrame) -> DataFrame:
    """order_date, sk_order_id, warehouse_section, section_pick_percentage.

    One aggregate by (order, section) - it also carries the section's first
    pick day - then window totals over the order. The window input is at most
    (orders x sections) rows and an order has few sections, so a huge order is
    no hot spot. A NULL order id matches no order total, so its date and share
    stay NULL.
    """
    per_section = f_order_picks.groupBy("sk_order_id", "warehouse_section").agg(
        F.sum("pick_volume").alias("section_volume"), F.min("pick_date").alias("first_day")
    )
    order = Window.partitionBy("sk_order_id")
    known = F.col("sk_order_id").isNotNull()
    return per_section.select(
        F.when(known, F.min("first_day").over(order)).alias("order_date"),
        "sk_order_id",
        "warehouse_section",
        F.when(known, share_percent(F.col("section_volume"), F.sum("section_volume").over(order))).alias(
            "section_pick_percentage"
        ),
    )


def avg_products_picked_per_order(f_order_picks: DataFrame, d_date: DataFrame) -> DataFrame:
    """Week, avg_products_picked_per_order (plain mean over orders)."""
    orders = f_order_picks.groupBy("sk_order_id").agg(
        F.min("pick_date").alias("order_date"),
        F.count_distinct("product_id").alias("unique_product_count"),
    )
    j = with_calendar(orders, d_date, "order_date", "week")
    return j.groupBy("week").agg(F.avg("unique_product_count").alias("avg_products_picked_per_order"))


def order_count_by_type(f_order_picks: DataFrame, d_date: DataFrame) -> DataFrame:
    """Weekly orders per origin, total, shares and ratios.

    Semantics of the original full outer join of two weekly counts, in one
    pass: counts of a missing origin are 0, but total and shares are NULL when
    a week has orders of only one origin; ratios are 0 when the divisor is 0;
    origins other than 46 and 48 are ignored. Out-of-calendar picks (NULL
    week) never pair up, so they give one row per origin.
    """
    picks = f_order_picks.filter(F.col("origin").isin(CUSTOMER_ORIGIN, STORE_ORIGIN))
    j = with_calendar(picks.select("pick_date", "origin", "sk_order_id"), d_date, "pick_date", "week")
    per_origin = j.groupBy("week", "origin").agg(F.count_distinct("sk_order_id").alias("orders"))
    null_split = F.when(F.col("week").isNull(), F.col("origin"))
    weekly = per_origin.groupBy("week", null_split.alias("_split")).agg(
        F.max(F.when(F.col("origin") == CUSTOMER_ORIGIN, F.col("orders"))).alias("_v48"),
        F.max(F.when(F.col("origin") == STORE_ORIGIN, F.col("orders"))).alias("_v46"),
    )
    v48, v46 = F.col("_v48"), F.col("_v46")
    o48 = F.coalesce(v48, F.lit(0).cast("bigint"))
    o46 = F.coalesce(v46, F.lit(0).cast("bigint"))

    def ratio(num, den):
        return F.when(den > 0, half_up(F.try_divide(num, den), 2)).otherwise(F.lit(0.0))

    return weekly.select(
        "week",
        o48.alias("order_volume_48"),
        o46.alias("order_volume_46"),
        (v48 + v46).alias("total_order_volume"),
        share_percent(v48, v48 + v46).alias("order_percentage_48"),
        share_percent(v46, v48 + v46).alias("order_percentage_46"),
        ratio(o46, o48).alias("ratio_46_48"),
        ratio(o48, o46).alias("ratio_48_46"),
    )
