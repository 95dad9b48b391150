"""Corpus pipeline over ``documents``: a table goes in, a sharded training mix comes out.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns the columns of ``documents``; the last adds the shard layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pickmarts.llm import decontamination, langid, minhash, mixing, sharding
from pickmarts.llm.columns import read_table, written


# Rows that go to Python at once: they stand in an executor's memory several times, outside its heap.
ARROW_ROWS = 1024


def _few_rows_at_once(stage):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
        return stage(spark, docs, sf_dir)

    return run


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter or of no language the network knows."""
    return langid.known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest id, of each group of near copies."""
    return minhash.without_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents into which an item of ``benchmark`` leaks."""
    return decontamination.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix of the sources wants it (0 to 2 times)."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds size, text_crc32, law, shard, slot and grown_shard to every row."""
    return sharding.shard_rows(docs, sharding.Tree.regular(), sharding.Tree.regular(sharding.SHARDS + 1))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing", mixing_sources),
    ("sharding", shards),
]

STAGES = [(name, _few_rows_at_once(stage)) for name, stage in STAGES]

# language ID, MinHash, alignment: not expressible in SQL; tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written in the shared folder and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
