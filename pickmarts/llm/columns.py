"""Small helpers for DataFrames shared by the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pickmarts.session import checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash_unit(*parts: Column) -> Column:
    """A uniform number in (0, 1) from the md5 of the joined parts: 52 bits, the same in any engine."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def drop_named(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that an operator is about to write (compared without case, as Spark does)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def fresh_prefix(*frames: DataFrame) -> str:
    """A prefix that no column of the frames begins with (compared without case), for helper columns."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for df in frames for c in df.columns):
        prefix += "_"
    return prefix


def running_total(
    df: DataFrame,
    group: list[str],
    block: str,
    order: list[Column],
    value: Column,
    out: str,
    totals_from: DataFrame | None = None,
) -> DataFrame:
    """``out`` = sum of ``value`` over the earlier rows of the same group, in the order (block, order).

    Exact in two levels, so that no task orders a whole group: the totals of the
    blocks (one row per group and block, summed map-side) give each block its
    offset, and rows are summed only inside their block. ``block`` must be a
    non-null long that ascends with the order; its size bounds a task.
    ``totals_from`` may give a cheaper DataFrame of the same rows for the totals.
    """
    base = totals_from if totals_from is not None else df
    p = fresh_prefix(df, base)
    sums = base.groupBy(*group, block).agg(F.sum(value).alias(f"{p}sum"))
    earlier = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(c).alias(f"{p}g{i}") for i, c in enumerate(group)],
        F.col(block).alias(f"{p}b"),
        F.coalesce(F.sum(f"{p}sum").over(earlier), F.lit(0)).cast("long").alias(f"{p}offset"),
    )
    inside = Window.partitionBy(*group, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn(f"{p}inside", F.coalesce(F.sum(value).over(inside), F.lit(0)).cast("long"))
    same = [F.col(c) == F.col(f"{p}g{i}") for i, c in enumerate(group)] + [F.col(block) == F.col(f"{p}b")]
    joined = rows.join(offsets, on=same, how="left")
    return joined.withColumn(out, F.col(f"{p}offset") + F.col(f"{p}inside")).drop(
        f"{p}inside", f"{p}offset", f"{p}b", *[f"{p}g{i}" for i in range(len(group))]
    )


def word_count(text: Column) -> Column:
    """Number of words: each word becomes one letter, then white space goes (memory follows the text)."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "x")
    return F.length(F.translate(marks, " \t\n\x0b\x0c\r", "")).cast("long")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read back.

    Cuts lineage: a lost executor reads the files again instead of recomputing.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """The intermediate tables of one operator, in a folder of its own in the shared checkpoint folder.

    ``keep`` writes a table (a cut of lineage, as ``written``), ``drop`` deletes
    tables that nothing reads any more. After each write the driver's JVM is asked
    to collect its garbage, so that the shuffle files of finished steps go as well.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        self.spark.sparkContext._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
