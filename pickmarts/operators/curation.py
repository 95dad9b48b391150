"""Curation jobs C2-C10: surrogate keys, the sign split, dimensions, enrichment.

The keyed pick table is built once; the three facts are filters of it:
``f_order_picks`` (volume > 0), ``f_pick_errors`` (volume = 0) and
``f_returns`` (volume < 0, sign flipped). The position key is computed before
the split, so each fact has gaps in it.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickmarts.operators.positions import BUCKET_UNIT, hot_cuts, running_position
from pickmarts.schemas import ENRICHED_FACT_COLUMNS, FACT_COLUMNS, STAGED_PICK_COLUMNS

log = logging.getLogger(__name__)

# Rows of one order (per origin) are numbered in this order. The timestamp
# decides; the other columns only break ties, so the numbering is repeatable.
POSITION_ORDER = ("pick_timestamp", "position_in_order", "product_id", "warehouse_section", "pick_volume")
POSITION_GROUP = ("sk_order_id", "origin")

PRODUCT_ATTRIBUTES = ("description", "product_group")

# The intended column names of returns.
RETURN_NAMES = {"pick_volume": "return_volume", "pick_timestamp": "return_timestamp", "pick_date": "return_date"}


def with_order_key(staged: DataFrame) -> DataFrame:
    """``sk_order_id = order_number || '_' || year(pick_timestamp)``.

    Order numbers are reused across years; the year makes them unique. A
    NULL order number gives a NULL key (``concat``, not ``concat_ws``).
    """
    key = F.concat(F.col("order_number"), F.lit("_"), F.year("pick_timestamp").cast("string"))
    return staged.select(*STAGED_PICK_COLUMNS, key.alias("sk_order_id"))


def with_position_key(keyed: DataFrame, bucket_unit: str = BUCKET_UNIT) -> DataFrame:
    """1-based position inside (sk_order_id, origin) by pick time.

    An order is numbered one range of it at a time, so an order of any size
    spreads over tasks (see ``pickmarts.operators.positions``; one small job looks
    for the ranges of hot orders). Picks without a timestamp have a NULL position.
    """
    group, order = list(POSITION_GROUP), list(POSITION_ORDER)
    cuts = hot_cuts(keyed, group, order, bucket_unit)
    return running_position(keyed, group, order, "sk_position_in_order", bucket_unit, cuts).select(*FACT_COLUMNS)


def curate_pick_data(staged: DataFrame, with_positions: bool = True, bucket_unit: str = BUCKET_UNIT) -> DataFrame:
    """C2 + C3: staged picks with both surrogate keys (all signs).

    ``with_positions=False`` leaves out the position key; no mart reads it,
    and it is the only costly step of curation.
    """
    keyed = with_order_key(staged)
    return with_position_key(keyed, bucket_unit) if with_positions else keyed


def pick_errors_fact(keyed: DataFrame) -> DataFrame:
    """C4: picks with volume 0."""
    return keyed.filter(F.col("pick_volume") == F.lit(0))


def returns_fact(keyed: DataFrame, legacy_names: bool = False) -> DataFrame:
    """Picks with negative volume, volume made positive.

    The intended column names are ``return_volume``, ``return_timestamp`` and
    ``return_date``. ``legacy_names=True`` keeps the pick_* names, which is
    what the original job actually wrote (its rename never took effect).
    """
    out = keyed.filter(F.col("pick_volume") < F.lit(0)).withColumn("pick_volume", -F.col("pick_volume"))
    if legacy_names:
        return out
    return out.withColumnsRenamed(RETURN_NAMES)


def order_picks_fact(keyed: DataFrame) -> DataFrame:
    """Picks with positive volume."""
    return keyed.filter(F.col("pick_volume") > F.lit(0))


def d_product_details(staged_products: DataFrame) -> DataFrame:
    """Product dimension (product_id, description, product_group)."""
    return staged_products.select("product_id", *PRODUCT_ATTRIBUTES)


def d_warehouse_section(staged_sections: DataFrame) -> DataFrame:
    """Warehouse-section dimension (abbreviation, description, group, pick_reference)."""
    return staged_sections.select("abbreviation", "description", "group", "pick_reference")


def duplicate_products(d_product: DataFrame) -> DataFrame:
    """Product ids listed more than once (each would multiply its facts)."""
    return d_product.groupBy("product_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def unique_products(d_product: DataFrame) -> DataFrame:
    """The product list, failing while it is read if a product id is listed twice (a NULL id never joins)."""
    one = d_product.where("product_id is not null").groupBy("product_id")
    one = one.agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in PRODUCT_ATTRIBUTES])
    twice = F.raise_error(F.concat(F.lit("product listed more than once: "), F.col("product_id")))
    return one.select(F.when(F.col("_n") > 1, twice).otherwise(F.col("product_id")).alias("product_id"), *PRODUCT_ATTRIBUTES)


def enrich(fact: DataFrame, d_product: DataFrame) -> DataFrame:
    """Add description and product_group by product_id.

    Left join with plain equality: a fact with a NULL product id keeps NULL
    attributes. The dimension must be unique on product_id (see
    ``duplicate_products``). The join strategy is left to the optimizer: a
    small product list is broadcast by its measured size, a large one is
    shuffled, and a product that dominates the facts is split by AQE's skew
    handling.
    """
    dim = d_product.select("product_id", *PRODUCT_ATTRIBUTES)
    cols = [c for c in ENRICHED_FACT_COLUMNS if c in fact.columns or c in PRODUCT_ATTRIBUTES]
    return fact.join(dim, "product_id", "left").select(*cols)
