"""Order-volume distribution marts M25-M27.

* M25 ``binned_order_volume``: orders per calendar day and volume bin, as a
  dense series: every calendar day x every bin label, 0 when empty.
* M26 ``weekly_zscore_distribution``: each order's volume in a period and
  its z-score against all orders of that period.
* M27 ``zscore_outliers``: the M26 rows with |z| > 3.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickmarts.functions.bins import BIN_EDGES, BIN_LABELS, bin_label
from pickmarts.operators.common import check_period, with_calendar

OUTLIER_THRESHOLD = 3.0


def binned_order_volume(
    f_order_picks: DataFrame,
    d_date: DataFrame,
    edges=BIN_EDGES,
    labels=BIN_LABELS,
) -> DataFrame:
    """Date, bins, order_volume, week, month, quarter, year_half.

    An order picked on two days counts once on each day (with that day's
    volume). Volumes outside the bins, and pick days outside the calendar,
    are not counted. The dense grid is the calendar with the labels exploded
    onto each day (no join for it), then the daily bin counts - at most
    (days x 7) rows - are looked up.
    """
    per_order_day = f_order_picks.groupBy("pick_date", "sk_order_id").agg(
        F.sum("pick_volume").alias("pick_volume")
    )
    counts = (
        per_order_day.select("pick_date", bin_label(F.col("pick_volume"), edges, labels).alias("_bin"))
        .groupBy("pick_date", "_bin")
        .agg(F.count(F.lit(1)).alias("order_volume"))
    )
    grid = d_date.select(
        "date",
        F.explode(F.array(*[F.lit(x) for x in labels])).alias("bins"),
        "week",
        "month",
        "quarter",
        "year_half",
    )
    j = grid.join(counts, (grid["date"] == counts["pick_date"]) & (grid["bins"] == counts["_bin"]), "left")
    return j.select(
        "date",
        "bins",
        F.coalesce(F.col("order_volume"), F.lit(0).cast("bigint")).alias("order_volume"),
        "week",
        "month",
        "quarter",
        "year_half",
    )


def period_moments(orders: DataFrame, period: str) -> DataFrame:
    """_period, _mean, _std of the integer ``pick_volume`` per period, from count, sum and sum of squares.

    The three are exact whole numbers (the squares as 38-digit decimals), so
    partial results merge without rounding; n * sum(x^2) - sum(x)^2 is taken
    before anything becomes a double. Fits periods of up to 1e12 orders of up
    to 1e7 units each; beyond that the sum fails instead of rounding.
    """
    volume = F.col("pick_volume").cast("decimal(19,0)")
    sums = orders.groupBy(F.col(period).alias("_period")).agg(
        F.count("pick_volume").alias("_n"),
        F.sum("pick_volume").alias("_sum"),
        F.sum((volume * volume).cast("decimal(38,0)")).alias("_squares"),
    )
    n, total = F.col("_n"), F.col("_sum").cast("decimal(19,0)")
    spread = (n.cast("decimal(19,0)") * F.col("_squares") - total * total).cast("decimal(38,0)")
    pairs = n.cast("double") * (n - 1).cast("double")
    std = F.sqrt(F.try_divide(spread.cast("double"), pairs))
    return sums.select(
        "_period",
        F.coalesce(F.try_divide(F.col("_sum").cast("double"), n.cast("double")), F.lit(0.0)).alias("_mean"),
        F.when(n > 1, std).otherwise(F.lit(1.0)).alias("_std"),
    )


def weekly_zscore_distribution(
    f_order_picks: DataFrame, d_date: DataFrame, period: str = "week"
) -> DataFrame:
    """sk_order_id, <period>, pick_volume, zscore.

    Per period: mean (0 when undefined) and sample standard deviation (1 when
    the period has a single order). z = (volume - mean) / std, NULL when std
    is 0. Both come from exact sums (see ``period_moments``), so a z-score does
    not depend on how rows were dealt to tasks. Orders outside the calendar have a NULL period and get NULL z.

    The per-period statistics are an aggregate with one row per period - at
    most the calendar's size plus one - so they are broadcast back to the
    orders; no window puts a busy period into one task.
    """
    period = check_period(period)
    cal_cols = [] if period == "date" else [period]
    j = with_calendar(f_order_picks.select("pick_date", "sk_order_id", "pick_volume"), d_date, "pick_date", *cal_cols)
    orders = j.groupBy("sk_order_id", period).agg(F.sum("pick_volume").alias("pick_volume"))
    stats = period_moments(orders, period)
    # NULL-safe join, NULL period masked below: a plain `=` would let the
    # optimizer push `period IS NOT NULL` into the statistics branch only,
    # and the two branches could no longer share one aggregate exchange.
    z = orders.join(F.broadcast(stats), orders[period].eqNullSafe(stats["_period"]), "left")
    zscore = F.try_divide(F.col("pick_volume") - F.col("_mean"), F.col("_std"))
    return z.select(
        "sk_order_id",
        period,
        "pick_volume",
        F.when(F.col(period).isNotNull(), zscore).alias("zscore"),
    )


def zscore_outliers(zscores: DataFrame, threshold: float = OUTLIER_THRESHOLD) -> DataFrame:
    """Rows of M26 whose |zscore| exceeds ``threshold``."""
    return zscores.filter(F.abs(F.col("zscore")) > F.lit(float(threshold)))
