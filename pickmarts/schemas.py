"""Declared schemas of every table the jobs read or write.

Raw files are headerless, so their column names and types are declared here
and never inferred (ids such as ``000010`` and ``D72590`` must stay strings).
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Text encoding of the raw CSV files.
RAW_ENCODING = "ISO-8859-1"


def _s(name: str) -> StructField:
    return StructField(name, StringType(), True)


# Raw column names. Raw pick data: product_id, warehouse_section, origin, order_number,
# position_in_order, pick_volume, quantity_unit, date.
RAW_PICK_DATA = StructType(
    [
        _s("product_id"),
        _s("warehouse_section"),
        _s("origin"),
        _s("order_number"),
        _s("position_in_order"),
        _s("pick_volume"),
        _s("quantity_unit"),
        _s("date"),
    ]
)

RAW_PRODUCT_DETAILS = StructType([_s("product_id"), _s("description"), _s("product_group")])

RAW_WAREHOUSE_SECTIONS = StructType(
    [_s("abbreviation"), _s("description"), _s("group"), _s("pick_reference")]
)

# Staged pick data: raw minus `date`, plus parsed timestamp and its date.
STAGED_PICK_DATA = StructType(
    [
        _s("product_id"),
        _s("warehouse_section"),
        StructField("origin", IntegerType(), True),
        _s("order_number"),
        _s("position_in_order"),
        StructField("pick_volume", LongType(), True),
        _s("quantity_unit"),
        StructField("pick_timestamp", TimestampNTZType(), True),
        StructField("pick_date", DateType(), True),
    ]
)

STAGED_PICK_COLUMNS = tuple(f.name for f in STAGED_PICK_DATA.fields)

# Curated facts add the two surrogate keys.
FACT_COLUMNS = STAGED_PICK_COLUMNS + ("sk_order_id", "sk_position_in_order")

# Enriched facts add the product attributes.
ENRICHED_FACT_COLUMNS = FACT_COLUMNS + ("description", "product_group")

D_DATE = StructType(
    [
        StructField("date", DateType(), False),
        StructField("year", IntegerType(), False),
        _s("week"),
        _s("month"),
        _s("quarter"),
        _s("year_half"),
    ]
)

CALENDAR_LABELS = ("week", "month", "quarter", "year_half", "year")
