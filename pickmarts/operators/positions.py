"""Running position inside a group, safe for groups of any size.

``row_number() over (partition by k order by o)`` sends each group to one
task. A group holding a large share of all rows (a huge order, or every row
without an order number) would be sorted by one task alone. Here the rows are
cut into ranges of (k, o), numbered inside their range, and a range's numbers
start after the rows of the group's earlier ranges:

* the first cut is by time: the timestamp truncated to ``bucket_unit`` (a fixed
  parameter);
* where a bucket still holds a large share of all rows, it is cut at quantiles of
  the whole order ``o``, taken from a sample of ``SAMPLE`` rows (``hot_cuts``).
  A cut leaves about ``PIECE`` sampled rows in a range, so there are at most
  SAMPLE / PIECE of them, whatever the size of the table; they are joined to the
  rows as a broadcast of that bound;
* the number of earlier rows is a running sum over per-range counts. The counts
  are an aggregate (combined map-side) with one narrow row per group and range.

The cuts decide only which task numbers a row, never its number, so a sample that
differs between runs gives the same result. Group keys are carried as (value,
is-null) pairs without NULLs inside the plan: the window and the join then need
the same partitioning, and the rows are shuffled once.

Rows without a timestamp have no place in the order: their position is NULL. They
are dealt to ranges of their own by a hash of the row.

Rows equal in every ordering column may trade numbers between runs, as with
``row_number``; they stay in one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Groups are numbered an hour at a time.
BUCKET_UNIT = "hour"

# Rows sampled to find buckets that need a further cut, and sampled rows a range keeps.
SAMPLE = 1 << 15
PIECE = 1 << 6

# Ranges that rows without a timestamp are dealt to.
NO_TIME_RANGES = 1 << 12

_BUCKET = "_pm_bucket"
_RANGE = "_pm_range"
_CUTS = "_pm_cuts"
_INSIDE = "_pm_inside"
_BEFORE = "_pm_before"


def _null_free(df: DataFrame, keys: list[str]) -> tuple[list[Column], list[str]]:
    """Every key as a value without NULLs and a flag, and their names."""
    cols, names = [], []
    for i, k in enumerate(keys):
        # any value will do where the flag says NULL
        empty = F.lit("").cast(df.schema[k].dataType) if df.schema[k].dataType.typeName() == "string" else F.lit(0)
        cols += [
            F.coalesce(F.col(k), empty.cast(df.schema[k].dataType)).alias(f"_pm_k{i}"),
            F.col(k).isNull().alias(f"_pm_n{i}"),
        ]
        names += [f"_pm_k{i}", f"_pm_n{i}"]
    return cols, names


def _prepared(df: DataFrame, keys: list[str], order: list[str], bucket_unit: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its null-free keys and the time bucket, and the keys' names."""
    key_cols, names = _null_free(df, keys)
    bucket = F.unix_seconds(F.date_trunc(bucket_unit, F.col(order[0])).cast("timestamp"))
    # rows without a timestamp get no number; a bucket without NULLs keeps join and window aligned
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(NO_TIME_RANGES)) - F.lit(1 << 62)
    return df.select("*", *key_cols, F.coalesce(bucket, spread).alias(_BUCKET)), names


def hot_cuts(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    bucket_unit: str = BUCKET_UNIT,
    sample: int = SAMPLE,
    piece: int = PIECE,
) -> DataFrame | None:
    """Where to cut the buckets that hold a large share of the rows; None where no bucket does.

    One row per such bucket: its keys, and an array of order values, ascending.
    A job over the keys and ordering columns of ``df``; at most sample / piece
    values reach the driver.
    """
    rows, names = _prepared(df.select(*dict.fromkeys([*keys, *order])), keys, order, bucket_unit)
    place = F.struct(*[F.col(c) for c in order]).alias("_pm_place")
    some = rows.where(F.col(order[0]).isNotNull()).select(*names, _BUCKET, place).orderBy(F.rand(7)).limit(sample)
    bucket = Window.partitionBy(*names, _BUCKET)
    number = some.select("*", F.row_number().over(bucket.orderBy("_pm_place")).alias("_pm_no"), F.count("*").over(bucket).alias("_pm_of"))
    last = number.where((F.col("_pm_no") % piece == 0) & (F.col("_pm_of") >= 2 * piece))
    cuts = last.groupBy(*names, _BUCKET).agg(F.array_sort(F.collect_list("_pm_place")).alias(_CUTS))
    found = cuts.collect()
    return df.sparkSession.createDataFrame(found, cuts.schema) if found else None


def running_position(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    out_col: str,
    bucket_unit: str = BUCKET_UNIT,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Add ``out_col`` = 1-based row number inside ``keys`` ordered by ``order``.

    ``order[0]`` must be a timestamp. ``order`` should make rows unique inside a
    group; otherwise ties are numbered in an arbitrary order, as with
    ``row_number``. ``cuts`` come from ``hot_cuts`` with the same arguments.
    """
    rows, names = _prepared(df, keys, order, bucket_unit)
    if cuts is None:
        rows = rows.withColumn(_RANGE, F.lit(0))
    else:
        known = [F.col(c).alias(f"{c}_c") for c in (*names, _BUCKET)]
        hot = F.broadcast(cuts.select(*known, _CUTS))  # at most SAMPLE / PIECE values
        rows = rows.join(hot, [F.col(c) == F.col(f"{c}_c") for c in (*names, _BUCKET)], "left")
        place = F.struct(*[F.col(c) for c in order])
        before = F.size(F.filter(F.col(_CUTS), lambda c: c < place))
        rows = rows.withColumn(_RANGE, F.when(F.col(_CUTS).isNull(), 0).otherwise(before))
        rows = rows.drop(_CUTS, *[f"{c}_c" for c in (*names, _BUCKET)])

    ranges = [_BUCKET, _RANGE]
    timed = rows.where(F.col(order[0]).isNotNull())
    counts = timed.groupBy(*names, *ranges).agg(F.count(F.lit(1)).alias("_pm_rows"))
    # a group's ranges: one narrow row each; the order of the group's earlier hours, then of the cuts
    earlier = Window.partitionBy(*names).orderBy(*ranges).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"{c}_o") for c in (*names, *ranges)],
        F.coalesce(F.sum("_pm_rows").over(earlier), F.lit(0)).alias(_BEFORE),
    )
    same = [F.col(c) == F.col(f"{c}_o") for c in (*names, *ranges)]
    inside = Window.partitionBy(*names, *ranges).orderBy(*order)
    numbered = rows.withColumn(_INSIDE, F.row_number().over(inside)).join(offsets, same, "left")
    position = F.when(F.col(order[0]).isNotNull(), F.col(_BEFORE) + F.col(_INSIDE)).cast("int")
    return numbered.select(*[F.col(c) for c in df.columns], position.alias(out_col))
