"""Layered Parquet storage (X1): ``<base>/<layer>/<table>``.

Layers are ``staging``, ``curation`` and ``data_mart``; marts of one family
share a sub-folder (``data_mart/<family>/<name>``). ``base`` is any Hadoop
path the cluster shares (object store or HDFS); nothing is machine-local.
Every write is an overwrite through Spark's commit protocol, so a retried
task or a lost executor never leaves partial output behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STAGING = "staging"
CURATION = "curation"
DATA_MART = "data_mart"


def layer_path(base: str, layer: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), layer, *parts])


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite ``path`` with ``df`` as Parquet."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
