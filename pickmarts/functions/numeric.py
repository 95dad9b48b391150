"""Numeric column helpers shared by the marts.

Spark's ``round`` goes through decimal text and rounds 0.07125 (binary
0.0712499...) up, while the pick marts were defined on an engine that rounds
the binary double. ``half_up`` uses the same binary arithmetic everywhere, so
results agree bit for bit with any SQL engine that evaluates the same formula.
Operands in the marts are never negative.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(x: Column, digits: int) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d`` as a double; NULL stays NULL."""
    scale = float(10**digits)
    return (F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).cast("double")


def share_percent(part: Column, whole: Column) -> Column:
    """Share of ``part`` in ``whole`` rounded to 4 digits, times 100.

    Division by zero gives NULL instead of an ANSI error.
    """
    return half_up(F.try_divide(part, whole), 4) * F.lit(100.0)
