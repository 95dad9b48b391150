"""Pre-aggregated inputs shared by many marts in a full run.

Most marts only need sums of pick volume or numbers of pick rows, and those
can be aggregated again at a coarser grain. A full run therefore reads the
(large) enriched facts a few times to build these inputs once, and feeds the
marts from them:

=================  ==============================================  =========================================
input              grain                                           feeds
=================  ==============================================  =========================================
hourly_volume      day, hour, origin, section, product group       pick volume (M01-M04), picks side of pick
                                                                   errors (M09-M12), throughput (M17-M20),
                                                                   section utilization (M24)
product_counts     day, product, origin, section, product group    top products (M13-M16)
error_counts       day, origin, section, product group             errors side of pick errors (M09-M12)
order_days         day, order, origin, section, product group      orders processed (M05-M08), order mix
                                                                   (M21), orders by origin (M23), binned
                                                                   volume (M25), z-scores (M26, M27)
=================  ==============================================  =========================================

Rows keep the fact column names; ``_rows`` says how many fact rows a row
stands for (see ``pickmarts.operators.common.row_count``), so the mart
functions run unchanged on either. Three of the inputs are bounded by the
dimensions (days x 24 x origins x sections x groups, or x products), not by
the number of picks; ``order_days`` is at most one row per order, day and
section, and the full run writes it bucketed by ``sk_order_id`` so that its
consumers, which all group or window by order, read it without a shuffle.
Only the distinct-products mart (M22) still reads the facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickmarts.operators.common import DRILL_DOWNS, ROWS

_G = list(DRILL_DOWNS)
_OWN = [g for g in _G if g != "product_group"]


def _by_group(per_product: DataFrame, products: DataFrame, keys: list[str], *sums: str) -> DataFrame:
    """Sums per product added up per product group; the lookup meets the aggregate, not the facts."""
    groups = products.select("product_id", "product_group")
    joined = per_product.join(groups, "product_id", "left")
    return joined.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def hourly_volume(f_order_picks: DataFrame, products: DataFrame) -> DataFrame:
    # The hour is rebuilt from the naive timestamp's parts: no session time
    # zone (and no daylight-saving gap) can move a pick to another hour.
    ts = F.col("pick_timestamp")
    hour = F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0)
    ).alias("pick_timestamp")
    per_product = f_order_picks.groupBy("pick_date", hour, *_OWN, "product_id").agg(
        F.sum("pick_volume").alias("pick_volume"), F.count(F.lit(1)).alias(ROWS)
    )
    return _by_group(per_product, products, ["pick_date", "pick_timestamp", *_G], "pick_volume", ROWS)


def product_counts(f_order_picks: DataFrame, products: DataFrame) -> DataFrame:
    per_product = f_order_picks.groupBy("pick_date", "product_id", *_OWN).agg(F.count(F.lit(1)).alias(ROWS))
    return per_product.join(products.select("product_id", "product_group"), "product_id", "left")


def error_counts(f_pick_errors: DataFrame, products: DataFrame) -> DataFrame:
    per_product = f_pick_errors.groupBy("pick_date", *_OWN, "product_id").agg(F.count(F.lit(1)).alias(ROWS))
    return _by_group(per_product, products, ["pick_date", *_G], ROWS)


def order_days(f_order_picks: DataFrame, products: DataFrame) -> DataFrame:
    # grouped by product group and order: the lookup has to come first
    enriched = f_order_picks.join(products.select("product_id", "product_group"), "product_id", "left")
    return enriched.groupBy("pick_date", "sk_order_id", *_G).agg(F.sum("pick_volume").alias("pick_volume"))


BUILDERS = {
    "hourly_volume": (hourly_volume, "picks"),
    "product_counts": (product_counts, "picks"),
    "error_counts": (error_counts, "errors"),
    "order_days": (order_days, "picks"),
}
