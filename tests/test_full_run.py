"""The full run (X2) on hand-written raw files."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from pickmarts.plans.full_run import (
    BUCKET_TABLE,
    RawFiles,
    read_enriched,
    read_fact,
    run_all,
    run_curation,
    run_marts,
    run_staging,
)
from pickmarts.plans.registry import MARTS, Facts


def _write(d: str, name: str, text: str) -> str:
    p = os.path.join(d, name)
    with open(p, "wb") as fh:
        fh.write(text.encode("iso-8859-1"))
    return p


PICKS = "\n".join(
    [
        "p1,bay,48,70001,01,24,pc,2018-01-30 10:52:31.000000",
        "p1,bay,48,70001,01,12,pc,2018-01-30 12:03:18.000000",
        "p2,aisle,48,70001,02,5,pc,2018-01-30 11:00:00.000000",
        "p2,aisle,46,70002,01,0,m,2018-01-30 04:04:56.000000",
        "p9,cart,48,70003,02,-4,m,2018-01-31 03:42:41.000000",
        "p3,aisle,48,70001,03,7,pc,2019-01-02 08:00:00.000000",
    ]
) + "\n"
PRODUCTS = 'p1,"Lamp, small",lamps\np2,Cable ä,cables\np9,Rail,fixings\n'
SECTIONS = "aisle,small parts,hall,A\nbay,pallets,hall,B\n"


@pytest.fixture(scope="module")
def run(spark):
    raw_dir = tempfile.mkdtemp(prefix="pickmarts-raw-")
    base = tempfile.mkdtemp(prefix="pickmarts-base-")
    raw = RawFiles(
        _write(raw_dir, "pick_data.csv", PICKS),
        _write(raw_dir, "product_details.csv", PRODUCTS),
        _write(raw_dir, "warehouse_sections.csv", SECTIONS),
    )
    written = run_all(spark, raw, base, start="2018-01-01", end="2018-12-31")
    return base, written


def test_all_marts_written(spark, run):
    base, written = run
    assert sorted(written) == sorted(MARTS)
    for name in written:
        path = os.path.join(base, "data_mart", MARTS[name].family, MARTS[name].table)
        assert os.path.isdir(path), path
        spark.read.parquet(path).collect()


def test_facts_by_kind(spark, run):
    base, _ = run
    picks = read_fact(spark, base, "f_order_picks")
    errors = read_fact(spark, base, "f_pick_errors")
    returns = read_fact(spark, base, "f_returns")
    assert (picks.count(), errors.count(), returns.count()) == (4, 1, 1)
    r = returns.collect()[0]
    assert r["return_volume"] == 4 and r["sk_order_id"] == "70003_2018"
    # positions are numbered before the split
    pos = {(x["product_id"], x["pick_volume"]): x["sk_position_in_order"] for x in picks.collect()}
    assert pos[("p1", 24)] == 1 and pos[("p2", 5)] == 2 and pos[("p1", 12)] == 3
    assert pos[("p3", 7)] == 1  # same order number, next year: new order


def test_mart_values(spark, run):
    base, _ = run
    vol = spark.read.parquet(os.path.join(base, "data_mart", "total_pick_volume", "total_pick_volume"))
    rows = {(r["date"].isoformat() if r["date"] else None): r["pick_volume"] for r in vol.collect()}
    assert rows == {"2018-01-30": 41, None: 7}  # 2019 is outside this calendar
    enriched = read_enriched(spark, base, "f_order_picks")
    groups = {r["product_id"]: r["product_group"] for r in enriched.collect()}
    assert groups == {"p1": "lamps", "p2": "cables", "p3": None}


def test_empty_section_list_writes_nothing(spark):
    raw_dir = tempfile.mkdtemp(prefix="pickmarts-raw-")
    base = tempfile.mkdtemp(prefix="pickmarts-base-")
    raw = RawFiles(
        _write(raw_dir, "pick_data.csv", PICKS),
        _write(raw_dir, "product_details.csv", ""),
        _write(raw_dir, "warehouse_sections.csv", ""),
    )
    run_staging(spark, raw, base)
    run_curation(spark, base, start="2018-01-01", end="2018-12-31")
    assert not os.path.exists(os.path.join(base, "curation", "d_warehouse_section"))
    assert os.path.isdir(os.path.join(base, "curation", "d_product_details"))  # written although empty
    enriched = read_enriched(spark, base, "f_order_picks")
    assert enriched.filter(F.col("description").isNotNull()).isEmpty()


def test_duplicate_products_are_rejected(spark):
    raw_dir = tempfile.mkdtemp(prefix="pickmarts-raw-")
    base = tempfile.mkdtemp(prefix="pickmarts-base-")
    raw = RawFiles(
        _write(raw_dir, "pick_data.csv", PICKS),
        _write(raw_dir, "product_details.csv", PRODUCTS + "p1,again,lamps\n"),
        _write(raw_dir, "warehouse_sections.csv", SECTIONS),
    )
    run_staging(spark, raw, base)
    run_curation(spark, base, start="2018-01-01", end="2018-12-31")
    with pytest.raises(ValueError):
        run_marts(spark, base)


def _rounded(df):
    return df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def test_shared_inputs_give_the_direct_results(spark, run):
    base, _ = run
    facts = Facts(
        read_enriched(spark, base, "f_order_picks"),
        read_enriched(spark, base, "f_pick_errors"),
        spark.read.parquet(os.path.join(base, "curation", "d_date")),
    )
    for name, spec in MARTS.items():
        written = _rounded(spark.read.parquet(os.path.join(base, "data_mart", spec.family, spec.table)))
        direct = _rounded(spec.build(facts))
        assert written.columns == direct.columns, name
        assert written.exceptAll(direct).isEmpty() and direct.exceptAll(written).isEmpty(), name


def test_full_run_on_driver_tables(spark):
    from conftest import SMOKE_DIR
    from pickmarts.plans.driver_queries import stage_driver_tables
    from pickmarts.sources.tpch_adapter import ADAPTER_CALENDAR_END, ADAPTER_CALENDAR_START

    base = tempfile.mkdtemp(prefix="pickmarts-base-")
    stage_driver_tables(spark, SMOKE_DIR, base)
    counts = run_curation(spark, base, ADAPTER_CALENDAR_START, ADAPTER_CALENDAR_END)
    assert counts == {"rows": 6000, "order_picks": 5620, "pick_errors": 361, "returns": 19}
    run_marts(spark, base)
    facts = Facts(
        read_enriched(spark, base, "f_order_picks"),
        read_enriched(spark, base, "f_pick_errors"),
        spark.read.parquet(os.path.join(base, "curation", "d_date")),
    )
    assert facts.f_order_picks.count() == 5620 and facts.f_pick_errors.count() == 361
    for name, spec in MARTS.items():
        written = _rounded(spark.read.parquet(os.path.join(base, "data_mart", spec.family, spec.table)))
        direct = _rounded(spec.build(facts))
        assert written.exceptAll(direct).isEmpty() and direct.exceptAll(written).isEmpty(), name


def test_sql_mart_writer(spark, run):
    from pickmarts.plans.full_run import run_sql_mart

    base, _ = run
    picks = read_enriched(spark, base, "f_order_picks")
    counts = run_sql_mart(
        spark,
        "SELECT origin, CAST(sum(pick_volume) AS BIGINT) AS pick_volume FROM {f} GROUP BY origin",
        "volume_by_origin",
        base,
        family="custom",
        f=picks,
    )
    assert counts == {"rows": 1}
    got = spark.read.parquet(os.path.join(base, "data_mart", "custom", "volume_by_origin")).collect()
    assert [(r["origin"], r["pick_volume"]) for r in got] == [(48, 48)]


def test_sorted_mart_output(spark, run):
    base, _ = run
    run_marts(spark, base, names=["total_orders_processed", "order_mix"], sort_output=True, parallelism=1)
    import glob

    import pyarrow.parquet as pq

    path = os.path.join(base, "data_mart", "total_orders_processed", "total_orders_processed")
    files = sorted(glob.glob(os.path.join(path, "part-*.parquet")))
    per_file = [pq.read_table(f).column("date").to_pylist() for f in files]
    per_file = [d for d in per_file if d]
    assert sum(len(d) for d in per_file) == 365
    for dates in per_file:
        assert dates == sorted(dates)  # each file is sorted ...
    for a, b in zip(per_file, per_file[1:]):
        assert a[-1] <= b[0]  # ... and files follow each other in part order


def test_published_layout(spark, run):
    base, _ = run
    assert sorted(os.listdir(os.path.join(base, "curation"))) == [
        "_keyed_picks", "d_date", "d_product_details", "d_warehouse_section",
        "f_order_picks", "f_pick_errors", "f_returns",
    ]
    returns = spark.read.parquet(os.path.join(base, "curation", "f_returns"))
    assert {"return_volume", "return_timestamp", "return_date"} <= set(returns.columns)
    assert "pick_volume" not in returns.columns
    throughput = os.listdir(os.path.join(base, "data_mart", "pick_throughput"))
    assert sorted(throughput) == [
        "pick_throughput", "pick_throughput_origin", "pick_throughput_product_group",
        "pick_throughput_warehouse_section", "pick_throughput_weekly",
    ]
    assert not spark.catalog.tableExists(BUCKET_TABLE)


def test_sections_are_sorted_descending_within_a_week(spark, run):
    import glob

    import pyarrow.parquet as pq

    base, _ = run
    name = "warehouse_utilization_per_section"
    run_marts(spark, base, names=[name], sort_output=True)
    files = sorted(glob.glob(os.path.join(base, "data_mart", name, name, "part-*.parquet")))
    rows = [(r["week"], r["warehouse_section"]) for f in files for r in pq.read_table(f).to_pylist()]
    assert rows == [("2018_05", "bay"), ("2018_05", "aisle"), (None, None)]


def test_full_run_from_raw_csv_matches_registered_queries(spark):
    """S1 -> X2 from headerless latin-1 CSV files equals the marts computed straight from the tables."""
    from conftest import SMOKE_DIR
    from pickmarts.plans.driver_queries import all_queries, product_details, staged_picks
    from pickmarts.sources.tpch_adapter import ADAPTER_CALENDAR_END, ADAPTER_CALENDAR_START

    raw_dir = tempfile.mkdtemp(prefix="pickmarts-rawcsv-")
    base = tempfile.mkdtemp(prefix="pickmarts-base-")

    def to_csv(df, name):
        path = os.path.join(raw_dir, name)
        (df.write.mode("overwrite").option("header", "false").option("encoding", "ISO-8859-1")
           .option("quote", '"').option("escape", '"').csv(path))
        return path

    picks = staged_picks(spark, SMOKE_DIR).select(
        "product_id", "warehouse_section", "origin", "order_number", "position_in_order", "pick_volume",
        "quantity_unit", F.date_format("pick_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("date"),
    )
    raw = RawFiles(
        to_csv(picks, "pick_data"),
        to_csv(product_details(spark, SMOKE_DIR), "product_details"),
        _write(raw_dir, "warehouse_sections.csv", SECTIONS),
    )
    run_all(spark, raw, base, start=ADAPTER_CALENDAR_START, end=ADAPTER_CALENDAR_END, multiline=False)
    queries = all_queries()
    for name, spec in MARTS.items():
        written = _rounded(spark.read.parquet(os.path.join(base, "data_mart", spec.family, spec.table)))
        direct = _rounded(queries[name](spark, SMOKE_DIR))
        assert written.exceptAll(direct).isEmpty() and direct.exceptAll(written).isEmpty(), name


def test_command_line_steps(spark):
    from pickmarts.__main__ import main

    raw_dir = tempfile.mkdtemp(prefix="pickmarts-raw-")
    base = tempfile.mkdtemp(prefix="pickmarts-base-")
    _write(raw_dir, "pick_data.csv", PICKS)
    _write(raw_dir, "product_details.csv", PRODUCTS)
    _write(raw_dir, "warehouse_sections.csv", SECTIONS)
    common = ["--base", base, "--start", "2018-01-01", "--end", "2018-12-31"]
    assert main(["staging", "--raw-dir", raw_dir, *common]) == 0
    assert main(["curation", *common]) == 0
    assert main(["marts", *common, "--marts", "total_pick_volume", "order_mix"]) == 0
    vol = spark.read.parquet(os.path.join(base, "data_mart", "total_pick_volume", "total_pick_volume"))
    assert sorted(r["pick_volume"] for r in vol.collect()) == [7, 41]
    assert not os.path.exists(os.path.join(base, "data_mart", "pick_errors"))
    with pytest.raises(SystemExit):
        main(["staging", *common])  # no raw files given


def test_order_level_marts_read_the_bucketed_input_without_shuffle(spark, run):
    from pickmarts.operators.orders import order_mix
    from pickmarts.plans.full_run import build_mart_inputs

    base, _ = run
    plain = build_mart_inputs(spark, base, {"order_days"})["order_days"]
    # collected now: the next build overwrites the same files
    from_plain = sorted(map(tuple, _rounded(order_mix(plain)).collect()), key=str)
    try:
        order_days = build_mart_inputs(spark, base, {"order_days"}, bucket_table="t_order_days", buckets=4)["order_days"]
        df = order_mix(order_days)
        assert sorted(map(tuple, _rounded(df).collect()), key=str) == from_plain and from_plain
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "Exchange hashpartitioning(sk_order_id" not in final
        with pytest.raises(ValueError):
            build_mart_inputs(spark, base, {"order_days"}, bucket_table="t_order_days")
    finally:
        spark.sql("DROP TABLE IF EXISTS t_order_days")
