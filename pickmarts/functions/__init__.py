"""Column-level helpers: calendar labels, rounding, bins, id padding.

Everything here returns a Spark ``Column`` built from built-in functions, so
it stays inside whole-stage codegen; there are no Python UDFs.
"""

from pickmarts.functions.bins import BIN_EDGES, BIN_LABELS, bin_label
from pickmarts.functions.calendar import (
    month_label,
    quarter_label,
    week_label,
    year_half_label,
    year_label,
)
from pickmarts.functions.numeric import half_up, share_percent
from pickmarts.functions.text import zero_pad

__all__ = [
    "BIN_EDGES",
    "BIN_LABELS",
    "bin_label",
    "half_up",
    "month_label",
    "quarter_label",
    "share_percent",
    "week_label",
    "year_half_label",
    "year_label",
    "zero_pad",
]
