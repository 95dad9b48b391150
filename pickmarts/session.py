"""Session settings the jobs rely on.

The jobs themselves never create a session; they take DataFrames. This module
is for entry points (scripts, tests, bench) and for reading the cluster's
checkpoint folder.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the results depend on: naive timestamps are read as such, ANSI
# arithmetic fails loudly, and the session zone cannot shift `hour()`.
REQUIRED_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}

# Settings for scale: runtime re-planning, skew splitting, partition coalescing.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "pickmarts",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create or get a session with the required and scale settings."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {**REQUIRED_CONF, **SCALE_CONF, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession, fallback_prefix: str = "pickmarts-ckpt-") -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it; only a local session without one gets a private folder.
    Elsewhere a missing setting is an error: a folder of the driver's own would
    not be seen by the executors.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix=fallback_prefix)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
