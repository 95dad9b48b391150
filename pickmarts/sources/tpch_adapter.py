"""Driver tables in the role of the raw pick files.

The test data offers order lines (``lineitem``) and parts (``part``) but no
pick log. This source maps them onto the pick schemas (staged, and raw text) so
that every job runs on data whose size grows with the scale factor:

============================  =================================================
pick column                   from
============================  =================================================
product_id                    l_partkey, zero-padded to 8
warehouse_section             l_returnflag A -> AKL, N -> HRL, else Manuell
origin                        46 when l_orderkey % 3 = 0, else 48
order_number                  floor(l_orderkey / 8), zero-padded to 8 (numbers
                              repeat across years on purpose)
position_in_order             l_linenumber, zero-padded to 4
pick_volume                   sign * int(l_quantity) * (l_partkey % 12 + 1); sign 0
                              when l_tax = 0, -1 when l_tax > 0.075 and
                              l_discount > 0.095, else 1
quantity_unit                 'St'
pick_timestamp                l_shipdate + (l_orderkey*7919 + l_partkey*3571 +
                              l_linenumber*613) % 86400 seconds
pick_date                     date of l_shipdate
============================  =================================================

The section list comes from ``supplier`` and ``nation``, as raw text: abbreviation =
s_name, description = n_name, group = the nation's region key, pick_reference =
balance class A to C, or a missing-value token when s_suppkey % 7 = 0.

The product list comes from ``part``: product_id as above, description =
p_name, product_group = p_type except NULL when p_partkey % 50 = 7.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pickmarts.functions.text import zero_pad_sql
from pickmarts.schemas import STAGED_PICK_COLUMNS

# Calendar range used with the driver tables. It leaves pick
# days on both sides outside the calendar on purpose.
ADAPTER_CALENDAR_START = "1995-07-01"
ADAPTER_CALENDAR_END = "2001-06-30"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The mapping as SQL expressions: each column is handed to the JVM as one
# expression (one round trip) instead of being composed call by call.
_PICK_EXPRESSIONS = (
    f"{zero_pad_sql('l_partkey', 8)} AS product_id",
    "CASE WHEN l_returnflag = 'A' THEN 'AKL' WHEN l_returnflag = 'N' THEN 'HRL' ELSE 'Manuell' END AS warehouse_section",
    "CAST(CASE WHEN l_orderkey % 3 = 0 THEN 46 ELSE 48 END AS INT) AS origin",
    f"{zero_pad_sql('CAST(floor(l_orderkey / 8) AS BIGINT)', 8)} AS order_number",
    f"{zero_pad_sql('l_linenumber', 4)} AS position_in_order",
    "CAST((CASE WHEN l_tax = 0.0 THEN 0 WHEN l_tax > 0.075 AND l_discount > 0.095 THEN -1 ELSE 1 END)"
    " * CAST(l_quantity AS BIGINT) * (l_partkey % 12 + 1) AS BIGINT) AS pick_volume",
    "'St' AS quantity_unit",
    "timestampadd(SECOND, (l_orderkey * 7919 + l_partkey * 3571 + l_linenumber * 613) % 86400,"
    " CAST(l_shipdate AS TIMESTAMP_NTZ)) AS pick_timestamp",
    "CAST(CAST(l_shipdate AS TIMESTAMP_NTZ) AS DATE) AS pick_date",
)


# The same rows as a raw pick file would hold them: numbers and date as text.
_RAW_EXPRESSIONS = (
    "product_id",
    "warehouse_section",
    "CAST(origin AS STRING) AS origin",
    "order_number",
    "position_in_order",
    "CAST(pick_volume AS STRING) AS pick_volume",
    "quantity_unit",
    "date_format(pick_timestamp, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS date",
)

# What the sign of the volume means in terms of the order lines.
# Filters on these columns reach the scan; the sign itself is computed.
LINES_OF = {"errors": "l_tax = 0.0", "picks": "l_tax != 0.0 OR l_tax IS NULL"}


def picks_from_lineitem(lineitem: DataFrame, lines: str | None = None) -> DataFrame:
    """Staged pick rows (9 columns) from order lines, all or a superset of one kind (``LINES_OF``)."""
    if lines:
        lineitem = lineitem.where(LINES_OF[lines])
    return lineitem.selectExpr(*_PICK_EXPRESSIONS).select(*STAGED_PICK_COLUMNS)


def raw_picks_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """The order lines as raw pick rows, input of the staging job."""
    return picks_from_lineitem(lineitem).selectExpr(*_RAW_EXPRESSIONS)


def products_from_part(part: DataFrame) -> DataFrame:
    """Product list (product_id, description, product_group) from ``part``."""
    return part.selectExpr(
        f"{zero_pad_sql('p_partkey', 8)} AS product_id",
        "p_name AS description",
        "CASE WHEN p_partkey % 50 = 7 THEN CAST(NULL AS STRING) ELSE p_type END AS product_group",
    )


def raw_sections_from_suppliers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Raw section rows, input of the staging job."""
    rows = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"], "left")
    return rows.selectExpr(
        "s_name AS abbreviation",
        "n_name AS description",
        "CAST(n_regionkey AS STRING) AS `group`",
        "CASE WHEN s_suppkey % 7 = 0 THEN 'NA' WHEN s_acctbal < 0 THEN 'C' WHEN s_acctbal < 5000 THEN 'B' ELSE 'A' END"
        " AS pick_reference",
    )


def staged_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return picks_from_lineitem(read_table(spark, sf_dir, "lineitem"))


def product_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products_from_part(read_table(spark, sf_dir, "part"))
