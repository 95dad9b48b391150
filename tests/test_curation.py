"""C2-C10 and the skew-safe running position."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import ORACLE_DIR, SMOKE_DIR, ts
from pickmarts.operators import curation as cur
from pickmarts.operators.positions import hot_cuts, running_position
from pickmarts.schemas import STAGED_PICK_DATA
from pickmarts.sources.tpch_adapter import staged_picks


def _staged(spark, rows):
    out = []
    for product, section, origin, order, pos, vol, when in rows:
        t = ts(when)
        out.append((product, section, origin, order, pos, vol, "St", t, t.date()))
    return spark.createDataFrame(out, STAGED_PICK_DATA)


@pytest.fixture(scope="module")
def staged(spark):
    return _staged(
        spark,
        [
            ("A", "HRL", 48, "0001", "0001", 5, "2018-01-30 10:00:00"),
            ("B", "AKL", 48, "0001", "0002", 0, "2018-01-30 09:00:00"),
            ("C", "AKL", 48, "0001", "0003", -2, "2018-01-30 11:00:00"),
            ("D", "HRL", 46, "0001", "0001", 7, "2018-01-30 08:00:00"),
            ("E", "HRL", 48, "0001", "0001", 3, "2019-01-02 08:00:00"),  # same number, next year
            ("F", "HRL", 48, None, "0001", 4, "2019-01-02 09:00:00"),
        ],
    )


def test_order_key_and_positions(staged):
    keyed = cur.curate_pick_data(staged)
    got = {r["product_id"]: (r["sk_order_id"], r["sk_position_in_order"]) for r in keyed.collect()}
    assert got["B"] == ("0001_2018", 1)  # earliest pick of (0001_2018, 48)
    assert got["A"] == ("0001_2018", 2)
    assert got["C"] == ("0001_2018", 3)
    assert got["D"] == ("0001_2018", 1)  # other origin, own numbering
    assert got["E"] == ("0001_2019", 1)
    assert got["F"] == (None, 1)  # NULL order number keeps a NULL key


def test_sign_split_partitions_rows_and_keeps_gaps(staged):
    keyed = cur.curate_pick_data(staged)
    picks = cur.order_picks_fact(keyed)
    errors = cur.pick_errors_fact(keyed)
    returns = cur.returns_fact(keyed)
    assert picks.count() + errors.count() + returns.count() == keyed.count()
    assert [r["sk_position_in_order"] for r in errors.collect()] == [1]
    assert sorted(r["sk_position_in_order"] for r in picks.filter(F.col("origin") == 48).collect()) == [1, 1, 2]
    r = returns.collect()[0]
    assert r["return_volume"] == 2 and r["return_date"].isoformat() == "2018-01-30"
    assert "pick_volume" not in returns.columns
    legacy = cur.returns_fact(keyed, legacy_names=True).collect()[0]
    assert legacy["pick_volume"] == 2


def test_enrichment_left_join_and_duplicates(spark, staged):
    keyed = cur.curate_pick_data(staged, with_positions=False)
    dim = spark.createDataFrame(
        [("A", "lamp", "35_Leuchten"), ("D", "cable", None), ("Z", "unused", "x")],
        "product_id string, description string, product_group string",
    )
    enriched = cur.enrich(cur.order_picks_fact(keyed), dim)
    rows = {r["product_id"]: (r["description"], r["product_group"]) for r in enriched.collect()}
    assert rows == {"A": ("lamp", "35_Leuchten"), "D": ("cable", None), "E": (None, None), "F": (None, None)}
    assert enriched.columns[-2:] == ["description", "product_group"]
    assert cur.duplicate_products(dim).isEmpty()
    assert not cur.duplicate_products(dim.unionByName(dim.limit(1))).isEmpty()


@pytest.mark.parametrize("unit", ["minute", "hour", "year"])
def test_running_position_equals_plain_window(spark, unit):
    keyed = cur.with_order_key(staged_picks(spark, SMOKE_DIR))
    # A third of the rows share one NULL order key: a hot group.
    keyed = keyed.withColumn(
        "sk_order_id", F.when(F.col("pick_volume") % 3 == 0, F.lit(None)).otherwise(F.col("sk_order_id"))
    )
    keys = list(cur.POSITION_GROUP)
    order = list(cur.POSITION_ORDER)
    plain = keyed.withColumn("pos", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    got = running_position(keyed, keys, order, "pos", unit)
    assert got.count() == plain.count()
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()


def test_rows_without_timestamp_have_no_position(spark):
    keyed = cur.with_order_key(staged_picks(spark, SMOKE_DIR))
    gone = F.when(F.col("position_in_order") != "0002", F.col("pick_timestamp"))
    rows = cur.with_position_key(keyed.withColumn("pick_timestamp", gone)).select("pick_timestamp", "sk_position_in_order")
    assert rows.where("(pick_timestamp IS NULL) != (sk_position_in_order IS NULL)").isEmpty()
    assert not rows.where("pick_timestamp IS NULL").isEmpty()


def test_positions_shuffle_the_facts_once_and_cache_nothing(spark):
    keyed = cur.with_order_key(staged_picks(spark, SMOKE_DIR))
    cached = set(spark.sparkContext._jsc.getPersistentRDDs())
    df = cur.with_position_key(keyed)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    wide = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "ReusedExchange" not in x]
    # the facts, the counts for their running sum, the running sums for the join
    assert len(wide) == 3, plan
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) == cached


def _hot_hour(keyed):
    """A third of the rows in one order, origin and hour; what the hour leaves open, later columns order."""
    hot = F.col("position_in_order") <= "0002"
    return keyed.withColumns(
        {
            "sk_order_id": F.when(hot, F.lit("hot_1998")).otherwise(F.col("sk_order_id")),
            "origin": F.when(hot, F.lit(46)).otherwise(F.col("origin")),
            "pick_timestamp": F.when(
                hot, F.expr("timestampadd(SECOND, minute(pick_timestamp), timestamp_ntz'1998-03-01 10:00:00')")
            ).otherwise(F.col("pick_timestamp")),
        }
    )


def test_cuts_of_a_hot_hour_keep_every_number(spark):
    keyed = _hot_hour(cur.with_order_key(staged_picks(spark, SMOKE_DIR)))
    keys, order = list(cur.POSITION_GROUP), list(cur.POSITION_ORDER)
    cuts = hot_cuts(keyed, keys, order, sample=1024, piece=16)
    hot = cuts.collect()
    # only the hot bucket is cut, and its cuts ascend
    assert len(hot) == 1 and hot[0]["_pm_k0"] == "hot_1998" and 8 <= len(hot[0]["_pm_cuts"]) <= 1024 // 16
    assert hot[0]["_pm_cuts"] == sorted(hot[0]["_pm_cuts"])
    plain = keyed.withColumn("pos", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("int"))
    got = running_position(keyed, keys, order, "pos", cuts=cuts)
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()


@pytest.mark.parametrize("case", ["one hour of one order", "no timestamp", "plain"])
def test_no_task_numbers_three_times_the_median(spark, case):
    keyed = cur.with_order_key(staged_picks(spark, ORACLE_DIR))
    if case == "one hour of one order":
        keyed = _hot_hour(keyed)
    elif case == "no timestamp":
        gone = F.when(F.col("position_in_order") > "0002", F.col("pick_timestamp"))
        keyed = cur.with_order_key(staged_picks(spark, ORACLE_DIR).withColumn("pick_timestamp", gone))
    settings = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = cur.with_position_key(keyed).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = sorted(r["count"] for r in rows)
    assert len(sizes) == 32 and sizes[-1] <= 3 * sizes[len(sizes) // 2], sizes


def test_no_hot_bucket_gives_no_cuts(spark):
    keyed = cur.with_order_key(staged_picks(spark, SMOKE_DIR))
    assert hot_cuts(keyed, list(cur.POSITION_GROUP), list(cur.POSITION_ORDER)) is None
    assert hot_cuts(keyed.where("false"), list(cur.POSITION_GROUP), list(cur.POSITION_ORDER)) is None


def test_positions_equal_pandas_cumcount(spark):
    """Same numbers as pandas: sort by the position order, cumcount per (order, origin), plus one."""
    keyed = cur.curate_pick_data(staged_picks(spark, SMOKE_DIR))
    pdf = keyed.toPandas()
    order = list(cur.POSITION_ORDER)
    ordered = pdf.sort_values(order, kind="mergesort")
    want = ordered.groupby(list(cur.POSITION_GROUP), sort=False).cumcount() + 1
    got = pdf.loc[want.index, "sk_position_in_order"]
    assert (got.to_numpy() == want.to_numpy()).all()
