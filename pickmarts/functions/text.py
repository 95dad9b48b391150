"""String helpers for identifiers with leading zeros."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_pad_sql(expr: str, width: int) -> str:
    """SQL that left-pads ``expr`` (cast to string) with zeros to ``width``.

    Unlike ``lpad`` alone, a longer value is kept whole instead of being cut
    to ``width`` characters, so distinct ids never collide.
    """
    s = f"CAST({expr} AS STRING)"
    return f"CASE WHEN length({s}) >= {width} THEN {s} ELSE lpad({s}, {width}, '0') END"


def zero_pad(expr: str, width: int) -> Column:
    return F.expr(zero_pad_sql(expr, width))
