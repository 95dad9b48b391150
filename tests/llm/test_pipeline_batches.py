"""Pipeline: how many rows and bytes stand in an executor's memory at once."""

from __future__ import annotations

import pyarrow as pa

import corpus_pipeline
from pickmarts.llm import minhash


def test_stages_hand_few_rows_to_python(spark, monkeypatch):
    """5,000 rows in one partition reach Python in batches of ``ARROW_ROWS`` at most."""
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.range(0, 5000, 1, 1).selectExpr("id as doc_id", "cast(id as string) as text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    try:
        for name, stage in corpus_pipeline.STAGES:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
            monkeypatch.setattr(corpus_pipeline.langid, "known_language", lambda d: d)
            monkeypatch.setattr(corpus_pipeline.minhash, "without_near_duplicates", lambda d: d)
            if name not in ("language_id", "near_dedup"):
                continue
            found = [r["n"] for r in stage(spark, docs, "").mapInArrow(sizes, "n long").collect()]
            assert sum(found) == 5000 and max(found) <= 1024
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)


def test_sketches_are_made_from_a_megabyte_at_a_time(monkeypatch):
    held = []
    real = minhash.texts_of
    monkeypatch.setattr(minhash, "texts_of", lambda c: held.append(real(c)) or held[-1])
    text = " ".join(f"w{k}" for k in range(5000))
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array([text] * 200)], names=["doc_id", "text"])
    assert sum(b.num_rows for b in minhash._sketch_batches(iter([batch]))) == 200
    assert max(len(t.data) for t in held) <= 1 << 20
