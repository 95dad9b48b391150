"""Staging jobs S1-S3: headerless latin-1 CSV -> typed DataFrame.

The raw files carry no header; names come from ``pickmarts.schemas`` and every
field is read as text. Quotes are escaped by doubling (``""``), fields may hold
commas (and newlines with ``multiline=True``), and the usual spreadsheet
missing-value tokens (``NA``, ``NULL``, ``nan`` ...) mean NULL.

Accepted as by the original loader: a missing ``date`` (NULL timestamp and
date), rows with fewer fields (the rest is NULL), blanks around numbers, dates
without zero padding, and up to nine fraction digits (cut to microseconds).
Rejected: a missing or non-numeric ``origin`` or ``pick_volume``, a date that
does not fit, and rows with too many fields. The checks are expressions in the
same scan, not an extra pass.

Pick data is read with ``multiline=False``, so that a large file is split across
tasks; a record broken over lines is reported by the checks. The two small lists
default to ``multiline=True``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pickmarts.schemas import (
    RAW_ENCODING,
    RAW_PICK_DATA,
    RAW_PRODUCT_DETAILS,
    RAW_WAREHOUSE_SECTIONS,
    STAGED_PICK_COLUMNS,
)

# Tokens the original loader reads as missing in text columns
# (the default missing-value list of pandas.read_csv).
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


# One field more than the schema has, to notice rows that are too long.
_SURPLUS = "_surplus"

# The raw timestamp as written by the picking system, and the parts of
# any spelling the original loader accepts.
_TIMESTAMP = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d{1,6}$"
_TIMESTAMP_PARTS = r"^\s*(\d{4})-(\d{1,2})-(\d{1,2}) (\d{1,2}):(\d{1,2}):(\d{1,2})\.(\d{1,9})\s*$"


def read_raw_csv(
    spark: SparkSession,
    path: str | list[str],
    schema,
    multiline: bool = True,
    encoding: str = RAW_ENCODING,
) -> DataFrame:
    """Scan headerless CSV as text columns named by ``schema``; short rows are padded, long rows fail."""
    names = [f.name for f in schema.fields]
    raw = (
        spark.read.schema(", ".join(f"`{n}` string" for n in [*names, _SURPLUS]))
        .option("header", "false")
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", str(multiline).lower())
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    too_long = F.raise_error(F.lit(f"a row has more than {len(names)} fields"))
    first = F.when(F.col(_SURPLUS).isNotNull(), too_long).otherwise(F.col(names[0])).alias(names[0])
    return raw.select(first, *[F.col(n) for n in names[1:]])


def _missing_to_null(c: str) -> Column:
    col = F.col(c)
    return F.when(col.isin(*MISSING_TOKENS), F.lit(None).cast("string")).otherwise(col).alias(c)


def _required(c: Column, name: str) -> Column:
    """Fail the job when ``c`` is NULL (a missing value the loader rejects)."""
    return F.when(c.isNull(), F.raise_error(F.lit(f"missing value in required column {name}"))).otherwise(c)


def _normalise_text(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            _missing_to_null(f.name) if f.dataType.typeName() == "string" else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _number(c: str, kind: str) -> Column:
    """A required number; blanks around it are ignored, anything else fails (ANSI cast)."""
    text = F.trim(F.col(c).cast("string"))
    return _required(F.when(text != "", text).cast(kind), c).alias(c)


def _timestamp(c: str) -> Column:
    """The raw timestamp; missing stays missing, a value that does not fit fails.

    The usual spelling is recognised by one pattern and cast as a whole; only
    rows of another spelling are taken apart.
    """
    part = lambda k: F.regexp_extract(c, _TIMESTAMP_PARTS, k)
    micros = F.substring(F.rpad(part(7), 6, "0"), 1, 6)
    seconds = F.concat(part(6), F.lit("."), micros).cast("decimal(8,6)")
    whole = [part(k).cast("int") for k in range(1, 6)]
    misfit = F.raise_error(F.concat(F.lit(f"{c} does not fit: "), F.col(c))).cast("timestamp_ntz")
    other = F.when(F.col(c).rlike(_TIMESTAMP_PARTS), F.make_timestamp_ntz(*whole, seconds)).otherwise(misfit)
    usual = F.col(c).cast("timestamp_ntz")  # a day or hour that does not exist fails here
    return F.when(F.col(c).isNull(), F.lit(None).cast("timestamp_ntz")).when(F.col(c).rlike(_TIMESTAMP), usual).otherwise(other)


def stage_pick_data(raw: DataFrame) -> DataFrame:
    """Parse ``date`` into ``pick_timestamp`` and ``pick_date``; drop ``date``."""
    df = _normalise_text(raw)
    return df.select(
        "product_id",
        "warehouse_section",
        _number("origin", "int"),
        "order_number",
        "position_in_order",
        _number("pick_volume", "bigint"),
        "quantity_unit",
        _timestamp("date").alias("pick_timestamp"),
    ).withColumn("pick_date", F.to_date("pick_timestamp")).select(*STAGED_PICK_COLUMNS)


def stage_product_details(raw: DataFrame) -> DataFrame:
    """Typed product list."""
    return _normalise_text(raw)


def stage_warehouse_sections(raw: DataFrame) -> DataFrame:
    """S3: typed warehouse-section list."""
    return _normalise_text(raw)


def read_pick_data(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    return stage_pick_data(read_raw_csv(spark, path, RAW_PICK_DATA, multiline))


def read_product_details(spark: SparkSession, path, multiline: bool = True) -> DataFrame:
    return stage_product_details(read_raw_csv(spark, path, RAW_PRODUCT_DETAILS, multiline))


def read_warehouse_sections(spark: SparkSession, path, multiline: bool = True) -> DataFrame:
    return stage_warehouse_sections(read_raw_csv(spark, path, RAW_WAREHOUSE_SECTIONS, multiline))
