"""Connected components of an edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickmarts.llm.columns import written


def _pointed(edges: DataFrame, keep_larger: bool) -> DataFrame:
    """Every node's least neighbour (or itself), handed to its larger or its smaller neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("least")).select(
        F.col("u").alias("__u"), F.least("u", "least").alias("least")
    )
    joined = edges.join(least, F.col("u") == F.col("__u"))
    if keep_larger:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return joined.where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v")).union(
        least.select(F.col("__u").alias("u"), F.col("least").alias("v"))
    )


def _step(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _pointed(both, keep_larger=True).where("u != v").distinct()
    # after the large star every edge points from the larger to the smaller node
    return _pointed(large, keep_larger=False).where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) for every node u that is not the least of its component, v being that least node.

    ``edges`` has long columns u and v (any direction, repeats allowed, u != v).
    Each step's edge list is written to the shared checkpoint folder and has at
    most as many rows as the one before; the number of steps grows with the
    logarithm of the longest path. Only counts and checksums reach the driver.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first())

    now = written(
        edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    last = state(now)
    while last[0]:
        now = written(_step(now), "stars")
        new = state(now)
        if new == last:
            break
        last = new
    return now
