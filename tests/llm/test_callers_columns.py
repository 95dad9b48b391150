"""Operators that hand on whole rows: no column of the caller is changed, dropped or tripped over."""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from pickmarts.llm import decontamination, langid, minhash, mixing, sharding, urlfilter
from pickmarts.llm.columns import fresh_prefix, read_table

SMALL = "/root/testdata/sf0.001"

# names that operators use for results or helpers
NAMES = (
    "size source_size target rank copies taken whole copy words hits at part item_id score lang_pred law shard slot "
    "grown_shard text_crc32 __size __key __tie __u __block __earlier __words __crc __copy __offset __inside __b __g0 "
    "__block_sum __removed __letter __lang __score __url __day __block blocked lists entries since row row_6"
).split()
NAMES = list(dict.fromkeys(NAMES))


@pytest.fixture(scope="module")
def docs(spark):
    df = read_table(spark, SMALL, "documents").drop("n_chars")
    df = df.selectExpr("*", "cast(length(text) as bigint) AS n_chars", *[f"concat('{n}', doc_id) AS `{n}`" for n in NAMES])
    df = df.cache()
    yield df
    df.unpersist()


def _rows(df, columns):
    return sorted(map(repr, map(tuple, df.select(*[f"`{c}`" for c in columns]).collect())))


def _same_values(out, docs):
    """Every row of ``out`` is a row of ``docs``, value by value."""
    assert out.columns == docs.columns
    have = set(_rows(docs, docs.columns))
    rows = _rows(out, docs.columns)
    assert rows and set(rows) <= have
    return rows


def test_filters_hand_on_every_value(spark, docs):
    _same_values(langid.known_language(docs), docs)
    _same_values(minhash.without_near_duplicates(docs), docs)
    _same_values(decontamination.decontaminated(docs, read_table(spark, SMALL, "benchmark")), docs)


def test_mixing_hands_on_every_value(docs):
    rows = _same_values(mixing.mixed_documents(docs), docs)
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(docs.select("doc_id", "source", "text"), mixing.word_count(docs["text"])).collect()}
    assert len(rows) == sum(taken.values())


def test_sharding_keeps_the_other_columns(docs):
    out = sharding.shard_rows(docs, sharding.Tree.regular(), sharding.Tree.regular(41))
    own = [c for c in docs.columns if c not in ("size", "text_crc32", "law", "shard", "slot", "grown_shard")]
    assert _rows(out, own) == _rows(docs, own)
    assert {r["law"] for r in out.select("law").distinct().collect()} == {"key"}


def test_judge_keeps_the_other_columns(spark):
    pages = read_table(spark, SMALL, "pages").drop("html")
    captures = urlfilter.page_captures(pages).selectExpr("*", *[f"'{n}' AS `{n}`" for n in NAMES])
    changes = spark.createDataFrame(
        [("l", "host", urlfilter_host(captures), "add", __import__("datetime").date(2023, 1, 1))],
        "list string, kind string, pattern string, action string, day date",
    )
    out = urlfilter.judge(captures, changes)
    own = [c for c in captures.columns if c not in ("blocked", "lists", "entries", "since")]
    assert _rows(out, own) == _rows(captures, own)
    assert out.where("blocked").count() > 0 and out.where("blocked and (lists != 'l' or entries != 1)").count() == 0


def urlfilter_host(captures) -> str:
    return captures.select(urlfilter.host_of(captures["url"]).alias("h")).where("h != ''").first()["h"]


def test_fresh_prefix(spark):
    df = spark.createDataFrame([(1, 2)], "__x int, ___Y int")
    assert not any(c.lower().startswith(fresh_prefix(df)) for c in df.columns)


def _write(folder, columns: dict, schema: pa.Schema) -> str:
    os.makedirs(folder, exist_ok=True)
    pq.write_table(pa.table(columns, schema), f"{folder}/documents.parquet")
    pq.write_table(pq.read_table(f"{SMALL}/benchmark.parquet"), f"{folder}/benchmark.parquet")
    return str(folder)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])


def test_pipeline_on_an_empty_table(spark, tmp_path):
    empty = {f.name: [] for f in SCHEMA}
    out = corpus_pipeline.run(spark, _write(tmp_path, empty, SCHEMA))
    assert out.collect() == []
    assert out.columns[:5] == SCHEMA.names


def test_pipeline_on_nulls_and_clashing_columns(spark, tmp_path):
    given = pq.read_table(f"{SMALL}/documents.parquet").to_pydict()
    n = len(given["doc_id"])
    for i in range(n):
        for name in given:
            if (i * 7 + len(name)) % 11 == 0:
                given[name][i] = None
    extra = {name: [f"{name}{i}" for i in range(n)] for name in ("whole", "__block", "rank", "target", "__u")}
    schema = SCHEMA
    for name in extra:
        schema = schema.append(pa.field(name, pa.string()))
    given = {f.name: given[f.name] for f in SCHEMA}
    rows = corpus_pipeline.run(spark, _write(tmp_path, {**given, **extra}, schema)).collect()
    have = {tuple(repr(v) for v in row) for row in zip(*given.values(), *extra.values())}
    assert rows
    for r in rows:
        assert tuple(repr(r[c]) for c in (*given, *extra)) in have
        assert r["text"] and 0 <= r["shard"] < 40
