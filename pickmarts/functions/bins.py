"""Right-closed order-volume bins.

Fixed values (must equal the original definition): the bin edges
0, 50, 150, 350, 600, 900, 200000 and the labels
mini, small, medium, large, extra_large, extreme, in that order.
A value v gets the label of the interval (left, right] that holds it;
values outside (0, 200000] get no label (NULL).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bin edges and labels of the order-volume categories.
BIN_EDGES = (0, 50, 150, 350, 600, 900, 200000)
BIN_LABELS = ("mini", "small", "medium", "large", "extra_large", "extreme")


def bin_label(v: Column, edges=BIN_EDGES, labels=BIN_LABELS) -> Column:
    """Label of the right-closed interval holding ``v`` (NULL when none).

    A ``when`` chain rather than ``Bucketizer``: Bucketizer bins are
    left-closed, and this stays a codegen expression.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    expr = None
    for left, right, label in zip(edges[:-1], edges[1:], labels):
        cond = (v > F.lit(left)) & (v <= F.lit(right))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr
