"""The full run (X2): raw CSV -> staging -> curation -> data marts.

Each layer is written as Parquet under one shared ``base`` path and the next
layer reads it back, so every layer boundary also cuts the lineage: a lost
executor recomputes from the last written layer, never from the raw files.

Layout::

    <base>/staging/{pick_data,product_details,warehouse_sections}
    <base>/curation/d_date
    <base>/curation/{f_order_picks,f_pick_errors,f_returns}
    <base>/curation/{d_product_details,d_warehouse_section}
    <base>/curation/_keyed_picks/kind={order_picks,pick_errors,returns}
    <base>/data_mart/_inputs/{hourly_volume,product_counts,error_counts,order_days}
    <base>/data_mart/_families/<family>/drill_down={none,product_group,origin,warehouse_section}
    <base>/data_mart/<family>/<mart>

The position key (the one costly curation step) is computed once, into
``_keyed_picks``; each published fact table is a copy of one of its partitions,
returns with their return_* names. The layout is the same for any input.

The facts are enriched when they are read, by a join whose strategy the
optimizer picks from the product list's measured size; no enriched copy is
written. Additive inputs are aggregated by product first and look the product
group up afterwards.

The marts are fed from a few pre-aggregated inputs
(``pickmarts.operators.mart_inputs``), each written once: a mart run reads the
facts 5 times instead of once per mart. A mart and its drill-downs come from one
aggregate over grouping sets (``pickmarts.operators.families``), written once and
partitioned by member; each published mart is a copy of one partition.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pickmarts.operators import curation as cur
from pickmarts.operators import families, mart_inputs
from pickmarts.operators.calendar_dim import DEFAULT_END, DEFAULT_START, create_d_date
from pickmarts.operators.distribution import OUTLIER_THRESHOLD
from pickmarts.operators.positions import BUCKET_UNIT
from pickmarts.plans.registry import FAMILIES, MARTS, Facts, MartSpec
from pickmarts.sources import staging as stg
from pickmarts.sources.layers import CURATION, DATA_MART, STAGING, layer_path, write_table

log = logging.getLogger(__name__)

# Fact kinds by sign of the pick volume.
KIND_ORDER_PICKS = "order_picks"
KIND_PICK_ERRORS = "pick_errors"
KIND_RETURNS = "returns"

FACT_KINDS = {"f_order_picks": KIND_ORDER_PICKS, "f_pick_errors": KIND_PICK_ERRORS, "f_returns": KIND_RETURNS}

# Shared mart inputs written bucketed by a key their consumers group on: the
# order-level input is aggregated and windowed by order in nine marts, which
# then read it without a shuffle.
BUCKETED_INPUTS = {"order_days": "sk_order_id"}

# Buckets of that input are the tasks of its consumers. Unless a number is given
# there is one for each ``BUCKET_BYTES`` of the pick facts as written (the input has
# at most a row per fact and fewer columns), and at least ``LEAST_BUCKETS``.
BUCKET_BYTES = 200 << 20
LEAST_BUCKETS = 8

# Name of the catalog table that a bucketed write needs while the marts run.
BUCKET_TABLE = "pickmarts_order_days"


@dataclass(frozen=True)
class RawFiles:
    """Locations of the three raw CSV inputs (file or folder each)."""

    pick_data: str
    product_details: str
    warehouse_sections: str


def write_observed(df: DataFrame, path: str, name: str, partition_by: list[str] | None = None, **metrics) -> dict:
    """Write ``df`` and return its row count (plus ``metrics``), logged.

    The counts are collected by ``observe`` while the write runs: no extra
    job over the data.
    """
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")] + [m.alias(k) for k, m in metrics.items()]
    write_table(df.observe(obs, *exprs), path, partition_by=partition_by)
    counts = dict(obs.get)
    log.info("%s: %s", name, ", ".join(f"{k}={v}" for k, v in counts.items()))
    return counts


def run_staging(spark: SparkSession, raw: RawFiles, base: str, multiline: bool = False) -> None:
    """S1-S3. ``multiline``: pick data holds quoted newlines (each file is then one task)."""
    write_observed(stg.read_pick_data(spark, raw.pick_data, multiline), layer_path(base, STAGING, "pick_data"), "pick_data")
    write_table(
        stg.read_product_details(spark, raw.product_details),
        layer_path(base, STAGING, "product_details"),
    )
    write_table(
        stg.read_warehouse_sections(spark, raw.warehouse_sections),
        layer_path(base, STAGING, "warehouse_sections"),
    )


def _kind_column() -> F.Column:
    v = F.col("pick_volume")
    return (
        F.when(v > 0, F.lit(KIND_ORDER_PICKS))
        .when(v == 0, F.lit(KIND_PICK_ERRORS))
        .when(v < 0, F.lit(KIND_RETURNS))
    )


def curate_facts(staged: DataFrame, bucket_unit: str = BUCKET_UNIT) -> DataFrame:
    """Keyed picks of all signs with a ``kind`` column."""
    return cur.curate_pick_data(staged, bucket_unit=bucket_unit).withColumn("kind", _kind_column())


def publish_dimension(df: DataFrame, path: str, name: str, write_when_empty: bool) -> bool:
    """Write a dimension; an empty one is logged, and written only if asked."""
    if df.isEmpty():
        log.warning("%s is empty%s", name, "" if write_when_empty else "; nothing written")
        if not write_when_empty:
            return False
    write_table(df, path)
    return True


def run_curation(
    spark: SparkSession,
    base: str,
    start: str = DEFAULT_START,
    end: str = DEFAULT_END,
    bucket_unit: str = BUCKET_UNIT,
) -> dict:
    """C1-C8. Returns the observed row counts of the fact table by kind."""
    write_table(create_d_date(spark, start, end), layer_path(base, CURATION, "d_date"))
    staged = spark.read.parquet(layer_path(base, STAGING, "pick_data"))
    by_kind = {k: F.count(F.when(F.col("kind") == k, 1)) for k in (KIND_ORDER_PICKS, KIND_PICK_ERRORS, KIND_RETURNS)}
    path = layer_path(base, CURATION, "_keyed_picks")
    counts = write_observed(curate_facts(staged, bucket_unit), path, "pick_facts", ["kind"], **by_kind)
    keyed = spark.read.parquet(path)
    for name, kind in FACT_KINDS.items():
        fact = keyed.filter(F.col("kind") == kind).drop("kind")
        write_table(cur.returns_fact(fact) if name == "f_returns" else fact, layer_path(base, CURATION, name))
    products = cur.d_product_details(spark.read.parquet(layer_path(base, STAGING, "product_details")))
    publish_dimension(products, layer_path(base, CURATION, "d_product_details"), "d_product_details", True)
    sections = cur.d_warehouse_section(spark.read.parquet(layer_path(base, STAGING, "warehouse_sections")))
    publish_dimension(sections, layer_path(base, CURATION, "d_warehouse_section"), "d_warehouse_section", False)
    return counts


def read_fact(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One fact table by its name (``f_order_picks``, ``f_pick_errors``, ``f_returns``)."""
    return spark.read.parquet(layer_path(base, CURATION, name))


def check_products_unique(d_product: DataFrame) -> None:
    """Q6: a product listed twice would multiply its facts in every mart."""
    if not cur.duplicate_products(d_product).isEmpty():
        raise ValueError("d_product_details lists a product_id more than once")


def read_products(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(layer_path(base, CURATION, "d_product_details"))


def read_enriched(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``f_order_picks`` or ``f_pick_errors`` with description and product_group."""
    return cur.enrich(read_fact(spark, base, name), read_products(spark, base))


def _run_all(tasks: list, parallelism: int) -> list:
    """Run independent write jobs, several at a time.

    Marts are small jobs; submitted one after another they leave most of a
    large cluster idle. Spark runs jobs from several driver threads side by
    side, and each write still commits on its own.
    """
    if parallelism <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files under ``path``."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.getContentSummary(hadoop_path).getLength()


def order_buckets(spark: SparkSession, base: str, bucket_bytes: int = BUCKET_BYTES, least: int = LEAST_BUCKETS) -> int:
    """Number of buckets of the order-level input, from the size of the pick facts."""
    size = stored_bytes(spark, layer_path(base, CURATION, "f_order_picks"))
    return max(-(-size // bucket_bytes), least)


def write_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` at ``path`` bucketed by ``key`` and return the bucketed table.

    Rows are repartitioned by the same hash first, so each task writes one bucket
    file. Bucketing needs a catalog table (an external one, at ``path``): ``table``,
    which must not exist yet and is the caller's to drop.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        raise ValueError(f"table {table} exists; name another one for the bucketed mart input")
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, key).option("path", path).saveAsTable(table)
    return spark.table(table)


def build_mart_inputs(
    spark: SparkSession,
    base: str,
    sources: set[str],
    parallelism: int = 1,
    bucket_table: str | None = None,
    buckets: int | None = None,
) -> dict[str, DataFrame]:
    """Write the shared inputs named in ``sources`` and return them read back.

    With ``bucket_table`` the order-level input is bucketed and registered under
    that name; without, it is plain files and its consumers shuffle it.
    """
    plain = {"picks": read_fact(spark, base, "f_order_picks"), "errors": read_fact(spark, base, "f_pick_errors")}
    products = read_products(spark, base)
    names = sorted(set(sources) - {"facts"})

    def write(name: str):
        def task():
            build, fact = mart_inputs.BUILDERS[name]
            path = layer_path(base, DATA_MART, "_inputs", name)
            df = build(plain[fact], products)
            if bucket_table and name in BUCKETED_INPUTS:
                n = buckets or order_buckets(spark, base)
                return name, write_bucketed(df, path, bucket_table, BUCKETED_INPUTS[name], n)
            write_table(df, path)
            return name, spark.read.parquet(path)

        return task

    out: dict[str, DataFrame] = dict(_run_all([write(n) for n in names], parallelism))
    out["facts"] = read_enriched(spark, base, "f_order_picks")
    out["facts_errors"] = read_enriched(spark, base, "f_pick_errors")
    # Marts without product attributes read the curated facts as they are.
    out["plain_facts"], out["plain_facts_errors"] = plain["picks"], plain["errors"]
    return out


def _facts_for(spec, inputs: dict[str, DataFrame], d_date: DataFrame) -> Facts:
    if spec.source == "facts":
        prefix = "" if spec.needs_products else "plain_"
        return Facts(inputs[f"{prefix}facts"], inputs[f"{prefix}facts_errors"], d_date)
    errors = inputs.get("error_counts") if spec.needs_errors else None
    return Facts(inputs[spec.source], errors, d_date)


def _sort_column(item: str) -> F.Column:
    name, _, direction = item.partition(" ")
    return F.col(name).desc_nulls_last() if direction == "desc" else F.col(name).asc_nulls_last()


def run_marts(
    spark: SparkSession,
    base: str,
    names: list[str] | None = None,
    sort_output: bool = False,
    shared_inputs: bool = True,
    parallelism: int = 4,
    bucket_table: str | None = BUCKET_TABLE,
    buckets: int | None = None,
) -> list[str]:
    """All marts of the registry (or ``names``), each written under its family.

    The product list is checked for duplicates first (Q6). With ``shared_inputs``
    (default) the marts read the pre-aggregated inputs; without, every mart reads
    the enriched facts itself. ``parallelism`` marts are written at a time.
    ``bucket_table`` names the catalog table of the bucketed order-level input,
    dropped again when the marts are written; None writes it unbucketed. ``buckets``
    None: by size (``order_buckets``).
    """
    check_products_unique(read_products(spark, base))
    specs = [MARTS[n] for n in (names or list(MARTS))]
    d_date = spark.read.parquet(layer_path(base, CURATION, "d_date"))
    sources = {s.source for s in specs} if shared_inputs else {"facts"}
    if shared_inputs and any(s.needs_errors for s in specs):
        sources.add("error_counts")
    table = bucket_table if sources & set(BUCKETED_INPUTS) else None
    inputs = build_mart_inputs(spark, base, sources, parallelism, table, buckets)

    # members of a family that are asked for together come from one pass
    together: dict[str, list[MartSpec]] = {}
    for s in specs if shared_inputs else []:
        if s.member_of:
            together.setdefault(s.member_of, []).append(s)
    together = {name: members for name, members in together.items() if len(members) > 1}

    def write_family(name):
        def task():
            members = together[name]
            df = FAMILIES[name](_facts_for(members[0], inputs, d_date), tuple(s.drill_down for s in members))
            path = layer_path(base, DATA_MART, "_families", name)
            write_table(df, path, partition_by=[families.MEMBER])
            return name, spark.read.schema(df.schema).parquet(path)

        return task

    def write(spec):
        def task():
            if spec.member_of in together:
                df = families.member(stacked[spec.member_of], spec.drill_down)
            elif shared_inputs:
                df = spec.build(_facts_for(spec, inputs, d_date))
            else:
                df = spec.build(Facts(inputs["facts"], inputs["facts_errors"], d_date))
            if sort_output and spec.sort_by:
                df = df.orderBy(*[_sort_column(c) for c in spec.sort_by])
            metrics = {}
            if "zscore" in df.columns:  # the original run logs the number of outliers
                metrics["outliers"] = F.count(F.when(F.abs(F.col("zscore")) > F.lit(OUTLIER_THRESHOLD), 1))
            write_observed(df, layer_path(base, DATA_MART, spec.family, spec.table), spec.name, **metrics)
            return spec.name

        return task

    try:
        stacked: dict[str, DataFrame] = dict(_run_all([write_family(n) for n in together], parallelism))
        return _run_all([write(s) for s in specs], parallelism)
    finally:
        if table:  # the external table's files stay under the mart inputs
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def run_sql_mart(
    spark: SparkSession,
    sql: str,
    name: str,
    base: str,
    family: str | None = None,
    **frames: DataFrame,
) -> dict:
    """Run SQL text over DataFrames and write it as ``data_mart/<family>/<name>``.

    Tables are referenced as ``{name}`` in the text and passed as keyword
    arguments (``spark.sql`` parameters), e.g.
    ``run_sql_mart(spark, "SELECT origin, sum(pick_volume) AS v FROM {f} GROUP BY origin", "by_origin", base, f=picks)``.
    Returns the observed row count.
    """
    df = spark.sql(sql, **frames)
    return write_observed(df, layer_path(base, DATA_MART, family or name, name), name)


def run_all(
    spark: SparkSession,
    raw: RawFiles,
    base: str,
    start: str = DEFAULT_START,
    end: str = DEFAULT_END,
    multiline: bool = False,
    sort_output: bool = False,
) -> list[str]:
    run_staging(spark, raw, base, multiline)
    run_curation(spark, base, start, end)
    return run_marts(spark, base, sort_output=sort_output)
