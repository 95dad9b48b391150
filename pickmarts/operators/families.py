"""Drill-down families from one pass: a mart and its drill-downs as GROUPING SETS.

A family is a mart and the same mart by product group, by origin and by
warehouse section. One aggregate over the grouping sets (keys), (keys, g1),
(keys, g2), (keys, g3) gives all members at once: one scan, one ``Expand``
(a row per member, combined map-side) and one shuffle instead of four of each.

Every family function returns its members stacked, with a column ``drill_down``
that names the member (``none`` for the plain mart) and one column per
drill-down, NULL where the member does not have it. ``member`` cuts one mart out;
written once and partitioned by ``drill_down``, that is a partition read.

Results are those of the single marts (``volume``, ``errors``, ``throughput``,
``top_products``), which stay the definition of each.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pickmarts.functions.numeric import half_up
from pickmarts.operators.common import DRILL_DOWNS, ROWS, drill_keys, row_count, with_calendar, with_rows
from pickmarts.operators.top_products import DEFAULT_TOP_N
from pickmarts.schemas import CALENDAR_LABELS

MEMBER = "drill_down"
PLAIN = "none"
ALL_MEMBERS: tuple[str | None, ...] = (None, *DRILL_DOWNS)

_GID = "_pm_gid"
_ERROR_KEYS = ("date", "week", "month")


def member_label(g: str | None) -> str:
    return g or PLAIN


def _drills(members: tuple[str | None, ...]) -> list[str]:
    if not members or len(set(members)) != len(members):
        raise ValueError("members must be different and at least one")
    return [k for m in members for k in drill_keys(m)]


def grouped_sets(df: DataFrame, keys: list[str], members: tuple[str | None, ...], *aggregates: Column) -> DataFrame:
    """drill_down, keys, drill-downs and ``aggregates`` of every member in one aggregate."""
    drills = _drills(members)
    sets = [[*keys, *drill_keys(m)] for m in members]
    # grouping_id has a bit for every column, the last one lowest, set where the column is rolled up
    every = (1 << len(drills)) - 1
    ids = {every ^ (1 << (len(drills) - 1 - drills.index(m)) if m else 0): member_label(m) for m in members}
    out = df.groupingSets(sets, *keys, *drills).agg(*aggregates, F.grouping_id(*keys, *drills).alias(_GID))
    label = reduce(lambda c, kv: c.when(F.col(_GID) == kv[0], kv[1]), ids.items(), F)
    return out.select(label.alias(MEMBER), *[c for c in out.columns if c != _GID])


def member(family: DataFrame, g: str | None) -> DataFrame:
    """One mart of a family, with its own columns."""
    others = {MEMBER, *DRILL_DOWNS} - {g}
    return family.where(F.col(MEMBER) == member_label(g)).select(*[c for c in family.columns if c not in others])


def pick_volume_family(f_order_picks: DataFrame, d_date: DataFrame, members: tuple[str | None, ...] = ALL_MEMBERS) -> DataFrame:
    """M01-M04."""
    drills = _drills(members)
    daily = grouped_sets(f_order_picks, ["pick_date"], members, F.sum("pick_volume").alias("pick_volume"))
    joined = with_calendar(daily, d_date, "pick_date", *CALENDAR_LABELS)
    volume = F.coalesce(F.col("pick_volume"), F.lit(0).cast("bigint")).alias("pick_volume")
    return joined.select(MEMBER, "date", *drills, volume, *CALENDAR_LABELS)


def orders_processed_family(
    f_order_picks: DataFrame, d_date: DataFrame, members: tuple[str | None, ...] = ALL_MEMBERS
) -> DataFrame:
    """Every member holds every calendar day."""
    drills = _drills(members)
    distinct = F.count_distinct("sk_order_id").alias("order_volume")
    daily = grouped_sets(f_order_picks, ["pick_date"], members, distinct).withColumnRenamed(MEMBER, "_member")
    labels = F.explode(F.array(*[F.lit(member_label(m)) for m in members])).alias(MEMBER)
    days = d_date.select("date", *CALENDAR_LABELS, labels)
    joined = days.join(daily, (F.col("date") == F.col("pick_date")) & (F.col(MEMBER) == F.col("_member")), "left")
    volume = F.coalesce(F.col("order_volume"), F.lit(0).cast("bigint")).alias("order_volume")
    return joined.select(MEMBER, "date", *drills, volume, *CALENDAR_LABELS)


def _weighted(fact: DataFrame, drills: list[str], errors: bool) -> DataFrame:
    rows = with_rows(fact, "pick_date", *drills)
    n = F.col(ROWS).cast("bigint") if ROWS in rows.columns else F.lit(1).cast("bigint")
    none = F.lit(0).cast("bigint")
    return rows.select("pick_date", *drills, (n if errors else none).alias("errors"), (none if errors else n).alias("picks"))


def _errors_reported(rows: DataFrame, d_date: DataFrame, members: tuple[str | None, ...]) -> DataFrame:
    drills = _drills(members)
    daily = grouped_sets(rows, ["pick_date"], members, F.sum("errors").alias("errors"), F.sum("picks").alias("picks"))
    days = with_calendar(daily, d_date, "pick_date", "week", "month")
    totals = days.groupBy(MEMBER, *_ERROR_KEYS, *drills)
    totals = totals.agg(F.sum("errors").alias("total_errors"), F.sum("picks").alias("picks"))
    own = [(F.col(MEMBER) == g) & F.col(g).isNull() for g in drills]
    unmatched = reduce(or_, [*[F.col(k).isNull() for k in _ERROR_KEYS], *own, F.col("picks") == 0])
    return totals.where("total_errors > 0").select(
        MEMBER, *_ERROR_KEYS, *drills, "total_errors", F.when(~unmatched, F.col("picks")).alias("total_picks")
    )


def pick_errors_family(
    f_order_picks: DataFrame, f_pick_errors: DataFrame, d_date: DataFrame, members: tuple[str | None, ...] = ALL_MEMBERS
) -> DataFrame:
    """M09-M12 from separately stored facts (or inputs with a row weight)."""
    drills = _drills(members)
    rows = _weighted(f_pick_errors, drills, errors=True).unionByName(_weighted(f_order_picks, drills, errors=False))
    return _errors_reported(rows, d_date, members)


def pick_errors_family_of_picks(picks: DataFrame, d_date: DataFrame, members: tuple[str | None, ...] = ALL_MEMBERS) -> DataFrame:
    """M09-M12 from picks of all signs, read once."""
    rows = picks.where("pick_volume >= 0").select(
        "pick_date",
        *_drills(members),
        (F.col("pick_volume") == 0).cast("bigint").alias("errors"),
        (F.col("pick_volume") > 0).cast("bigint").alias("picks"),
    )
    return _errors_reported(rows, d_date, members)


def throughput_family(f_order_picks: DataFrame, d_date: DataFrame, members: tuple[str | None, ...] = ALL_MEMBERS) -> DataFrame:
    """M17b and M18-M20."""
    drills = _drills(members)
    hour = F.hour("pick_timestamp").cast("int").alias("pick_hour")
    rows = f_order_picks.select("pick_date", hour, *drills, "pick_volume")
    hourly = grouped_sets(rows, ["pick_date", "pick_hour"], members, F.sum("pick_volume").alias("pick_volume"))
    weeks = with_calendar(hourly, d_date, "pick_date", "week").groupBy(MEMBER, "week", *drills)
    return weeks.agg(half_up(F.avg("pick_volume"), 2).alias("weekly_pick_throughput_avg"))


def top_products_family(
    f_order_picks: DataFrame,
    d_date: DataFrame,
    members: tuple[str | None, ...] = ALL_MEMBERS,
    n: int = DEFAULT_TOP_N,
) -> DataFrame:
    """M13-M16.

    Picks are counted by week and all drill-downs at once, in the tasks that hold a product if the
    facts are dealt by it; only these counts are repeated for each member and shuffled, once.
    """
    if int(n) < 1:
        raise ValueError("n must be at least 1")
    drills = _drills(members)
    picks = with_rows(f_order_picks, "pick_date", "product_id", *drills)
    daily = picks.groupBy("pick_date", "product_id", *drills).agg(row_count(picks).cast("bigint").alias("picks"))
    weeks = with_calendar(daily, d_date, "pick_date", "week").groupBy("week", "product_id", *drills)
    weeks = weeks.agg(F.sum("picks").alias("picks"))
    counts = grouped_sets(weeks, ["week", "product_id"], members, F.sum("picks").alias("total_picks"))
    w = Window.partitionBy(MEMBER, "week", *drills).orderBy(F.col("total_picks").desc(), F.col("product_id").asc_nulls_last())
    best = counts.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= F.lit(int(n)))
    return best.select(MEMBER, "week", "product_id", *drills, "total_picks")
