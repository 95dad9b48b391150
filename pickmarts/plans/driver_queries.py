"""Every job as a query over the driver's test tables (``lineitem``, ``part``).

Each entry is ``(spark, sf_dir) -> DataFrame``: it reads the whole tables,
maps them to pick data (``pickmarts.sources.tpch_adapter``), curates, and
runs one job. Nothing is sampled or capped.

Marts that never read product attributes skip the enrichment join: the product
list is made to fail where it is not unique on product_id
(``unique_products``), so a left join cannot change their rows. The marts also
skip the position key, which none of them reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pickmarts.operators import curation as cur
from pickmarts.operators import mart_inputs
from pickmarts.operators.calendar_dim import create_d_date
from pickmarts.operators.errors import pick_errors_of_picks
from pickmarts.operators.families import pick_errors_family_of_picks
from pickmarts.operators.top_products import top_n_products_weekly
from pickmarts.plans.registry import FAMILIES, MARTS, Facts, MartSpec
from pickmarts.session import checkpoint_dir
from pickmarts.sources import staging
from pickmarts.sources.staging import stage_pick_data, stage_product_details, stage_warehouse_sections
from pickmarts.sources.tpch_adapter import (
    ADAPTER_CALENDAR_END,
    ADAPTER_CALENDAR_START,
    picks_from_lineitem,
    product_details,
    raw_picks_from_lineitem,
    raw_sections_from_suppliers,
    read_table,
    staged_picks,
)

Query = Callable[[SparkSession, str], DataFrame]

# Order lines of a task that counts picks by product.
DEALT_ROWS = 1 << 18


def adapter_calendar(spark: SparkSession) -> DataFrame:
    return create_d_date(spark, ADAPTER_CALENDAR_START, ADAPTER_CALENDAR_END)


def keyed_picks(spark: SparkSession, sf_dir: str, with_positions: bool, lines: str | None = None) -> DataFrame:
    staged = picks_from_lineitem(read_table(spark, sf_dir, "lineitem"), lines)
    return cur.curate_pick_data(staged, with_positions=with_positions)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cur.d_product_details(stage_product_details(product_details(spark, sf_dir)))


def raw_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_sections_from_suppliers(read_table(spark, sf_dir, "supplier"), read_table(spark, sf_dir, "nation"))


def _through_csv(raw: DataFrame, read: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """The staging job on ``raw`` written as the raw files are: headerless, latin-1, quotes doubled."""
    spark = raw.sparkSession
    path = f"{checkpoint_dir(spark)}/raw-{uuid.uuid4().hex}"
    raw.write.option("encoding", "ISO-8859-1").option("escape", '"').option("header", "false").csv(path)
    return read(spark, path)


def by_product(picks: DataFrame, lines: int) -> DataFrame:
    """Picks dealt by product, a partition for each ``DEALT_ROWS`` of ``lines`` order lines.

    Enrichment and all counts by product happen in the tasks of this one shuffle; their number
    follows the input, whatever the session's number of partitions, and so a task's memory is bounded.
    """
    return picks.repartition(max(1, -(-lines // DEALT_ROWS)), "product_id")


def mart_facts(spark: SparkSession, sf_dir: str, spec: MartSpec) -> Facts:
    picks = cur.order_picks_fact(keyed_picks(spark, sf_dir, with_positions=False, lines="picks"))
    if spec.needs_products and spec.source == "product_counts":
        picks = by_product(picks, read_table(spark, sf_dir, "lineitem").count())
    if spec.needs_products:
        picks = cur.enrich(picks, cur.unique_products(products(spark, sf_dir)))
    return Facts(picks, None, adapter_calendar(spark))


def _mart_query(spec: MartSpec) -> Query:
    if not spec.needs_errors:
        return lambda spark, sf_dir: spec.build(mart_facts(spark, sf_dir, spec))

    def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
        # picks and errors come from one scan
        keyed = keyed_picks(spark, sf_dir, with_positions=False)
        if spec.needs_products:
            keyed = cur.enrich(keyed, cur.unique_products(products(spark, sf_dir)))
        return pick_errors_of_picks(keyed, adapter_calendar(spark), spec.drill_down)

    return errors


def _curation_queries() -> dict[str, Query]:
    def positioned(spark, sf_dir):
        return keyed_picks(spark, sf_dir, with_positions=True)

    def enriched(fact_of):
        return lambda s, d: cur.enrich(fact_of(positioned(s, d)), cur.unique_products(products(s, d)))

    return {
        "staged_pick_data": lambda s, d: stage_pick_data(raw_picks_from_lineitem(read_table(s, d, "lineitem"))),
        "csv_pick_data": lambda s, d: _through_csv(
            raw_picks_from_lineitem(read_table(s, d, "lineitem")), staging.read_pick_data
        ),
        "csv_warehouse_sections": lambda s, d: _through_csv(raw_sections(s, d), staging.read_warehouse_sections),
        "d_warehouse_section": lambda s, d: cur.d_warehouse_section(stage_warehouse_sections(raw_sections(s, d))),
        "d_product_details": products,
        "sk_order_id": lambda s, d: keyed_picks(s, d, with_positions=False),
        "sk_position_in_order": positioned,
        "f_pick_errors": lambda s, d: cur.pick_errors_fact(positioned(s, d)),
        "f_returns": lambda s, d: cur.returns_fact(positioned(s, d)),
        "f_order_picks": lambda s, d: cur.order_picks_fact(positioned(s, d)),
        "enrich_order_picks": enriched(cur.order_picks_fact),
        "enrich_pick_errors": enriched(cur.pick_errors_fact),
    }


def _zscore_period_query(period: str) -> Query:
    """M26 with another calendar column as the period (the full run uses week)."""
    from pickmarts.operators.distribution import weekly_zscore_distribution

    spec = MARTS["weekly_zscore_distribution"]
    return lambda spark, sf_dir: weekly_zscore_distribution(
        mart_facts(spark, sf_dir, spec).f_order_picks, adapter_calendar(spark), period
    )


def _top_3_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M13 with another n."""
    facts = mart_facts(spark, sf_dir, MARTS["top_n_products_weekly"])
    return top_n_products_weekly(facts.f_order_picks, facts.d_date, n=3)


def _shared_input_query(name: str) -> Query:
    """A pre-aggregated input of the full run, from the facts that feed it."""
    build, fact = mart_inputs.BUILDERS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        keyed = keyed_picks(spark, sf_dir, with_positions=False, lines=fact)
        facts = cur.order_picks_fact(keyed) if fact == "picks" else cur.pick_errors_fact(keyed)
        return build(facts, cur.unique_products(products(spark, sf_dir)))

    return run


def _family_query(name: str) -> Query:
    """A mart with all its drill-downs, stacked, from one pass over the enriched facts."""
    spec = MARTS[f"{name}_product_group"]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        members = tuple(s.drill_down for s in MARTS.values() if s.member_of == name)
        if spec.needs_errors:
            keyed = keyed_picks(spark, sf_dir, with_positions=False)
            enriched = cur.enrich(keyed, cur.unique_products(products(spark, sf_dir)))
            return pick_errors_family_of_picks(enriched, adapter_calendar(spark), members)
        return FAMILIES[name](mart_facts(spark, sf_dir, spec), members)

    return run


def all_queries() -> dict[str, Query]:
    out = _curation_queries()
    out.update({name: _mart_query(spec) for name, spec in MARTS.items()})
    for period in ("month", "year", "date", "quarter", "year_half"):
        out[f"zscore_distribution_{period}"] = _zscore_period_query(period)
    out["top_3_products_weekly"] = _top_3_products
    out.update({f"family_{name}": _family_query(name) for name in FAMILIES})
    out.update({f"input_{name}": _shared_input_query(name) for name in mart_inputs.BUILDERS})
    return out


def stage_driver_tables(spark: SparkSession, sf_dir: str, base: str) -> None:
    """Write the driver tables as the staging layer of a full run.

    Stands in for the CSV staging jobs: picks, products and sections come from
    the adapter.
    """
    from pickmarts.sources.layers import STAGING, layer_path, write_table

    write_table(staged_picks(spark, sf_dir), layer_path(base, STAGING, "pick_data"))
    write_table(product_details(spark, sf_dir), layer_path(base, STAGING, "product_details"))
    write_table(stage_warehouse_sections(raw_sections(spark, sf_dir)), layer_path(base, STAGING, "warehouse_sections"))
