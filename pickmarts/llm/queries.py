"""The operators of this subpackage as queries over the driver's tables, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pickmarts.llm import (
    decontamination,
    fmindex,
    htmltext,
    langid,
    merkle,
    minhash,
    mixing,
    ppm,
    sharding,
    spotsigs,
    suffixes,
    urlfilter,
    whitening,
)
from pickmarts.llm.columns import read_table

Query = Callable[[SparkSession, str], DataFrame]


def llm_queries() -> dict[str, Query]:
    return {
        "op1_sharding": lambda s, d: sharding.op1_shard(read_table(s, d, "documents")),
        "op2_substring_dedup": lambda s, d: fmindex.op2_dedup(read_table(s, d, "documents")),
        "op3_url_filter": lambda s, d: urlfilter.op3_judge(read_table(s, d, "pages")),
        "op4_minhash_dedup": lambda s, d: minhash.near_duplicates(read_table(s, d, "documents")),
        "op5_language_id": lambda s, d: langid.op5_identify(read_table(s, d, "documents")),
        "op6_html_text": lambda s, d: htmltext.op6_extract(read_table(s, d, "pages")),
        "op7_mixing": lambda s, d: mixing.op7_mix(read_table(s, d, "documents")),
        "op8_spotsigs": lambda s, d: spotsigs.likeness_to_next(read_table(s, d, "documents")),
        "op9_ppm": lambda s, d: ppm.op9_score(read_table(s, d, "documents")),
        "op10_decontamination": lambda s, d: decontamination.leaks(
            read_table(s, d, "documents"), read_table(s, d, "benchmark")
        ),
        "op11_suffix_dedup": lambda s, d: suffixes.op11_dedup(read_table(s, d, "documents")),
        "op12_merkle_manifest": lambda s, d: merkle.op12_manifest(read_table(s, d, "documents")),
        "op13_whitening": lambda s, d: whitening.op13_whiten(read_table(s, d, "embeddings")),
    }


def llm_oracle() -> dict[str, str]:
    return {
        "op1_sharding": sharding.ORACLE_SQL,
        "op2_substring_dedup": fmindex.ORACLE_SQL,
        "op3_url_filter": urlfilter.ORACLE_SQL,
        "op4_minhash_dedup": minhash.ORACLE_SQL,
        "op7_mixing": mixing.ORACLE_SQL,
        "op11_suffix_dedup": suffixes.ORACLE_SQL,
        "op12_merkle_manifest": merkle.ORACLE_SQL,
    }
