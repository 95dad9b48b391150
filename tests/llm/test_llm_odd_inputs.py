"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pickmarts.llm import (
    decontamination,
    fmindex,
    htmltext,
    langid,
    minhash,
    mixing,
    ppm,
    sharding,
    spotsigs,
    urlfilter,
)
from pickmarts.llm.columns import word_count

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, score double, "
    "label string, u long, v long, rank double, key string"
)
LONG = " ".join(f"word{i} the house is on a hill" for i in range(12_000))


def _row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, len(text or ""), 7, 3, 0.5, "x", 1, 2, 0.1, "k")


ROWS = [
    _row(1, "the cat sat on the mat and the dog was in the house with a big red ball for all of us to see"),
    _row(2, "the cat sat on the mat and the dog was in the house with a big red ball for all of us to see"),
    _row(2, "the cat sat on the mat and the dog was in the house with a big red ball for all of us to see"),
    _row(3, None, None, None),
    _row(4, ""),
    _row(5, " \t\n\x0b\x0c\r "),
    _row(None, "a document without an id is in the table and it is of no use to the others at all", "en", None),
    _row(None, None, None, None),
    _row(6, "12345 !!! 67 #", None, "t"),
    _row(7, LONG, "en", "t"),
    _row(8, "één woord", "nl", "é"),
    _row(-9, "x"),
    _row(2**62, "the cat sat on the mat and the dog was in the house with a big red ball for all of us to look at"),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=lambda x: (x is None, x))


ALL_IDS = sorted((r[0] for r in ROWS), key=lambda x: (x is None, x))


def test_sharding(docs, none):
    out = sharding.shard_rows(docs, sharding.Tree.regular(), sharding.Tree.regular(41))
    assert _ids(out) == ALL_IDS
    rows = out.collect()
    assert {r["law"] for r in rows} == {"key"}
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        assert r["size"] == len((r["text"] or "").encode()) + 16  # replaces the input's size
        assert r["grown_shard"] in (r["shard"], 40)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert len({r["shard"] for r in rows if r["doc_id"] == 2}) == 1
    assert sharding.op1_shard(none).count() == 0


def test_substring_dedup(docs, none):
    rows = fmindex.op2_dedup(docs).collect()
    assert _ids(docs) == sorted((r["doc_id"] for r in rows), key=lambda x: (x is None, x))
    got = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert got[1]["n_removed"] == 0 and got[1]["n_words"] == 24
    assert got[2]["n_removed"] == 24  # both rows of id 2, by id 1
    assert got[2**62]["n_removed"] == 23  # all but the last two words, "look at"
    assert got[3]["n_words"] == got[5]["n_words"] == 0
    assert {r["n_removed"] for r in rows if r["doc_id"] is None} == {0}
    assert fmindex.op2_dedup(none).count() == 0
    texts = {r["doc_id"]: r["text"] for r in fmindex.dedup_substrings(docs).collect()}
    assert texts[2] == "" and texts[2**62] == "look at" and texts[8] == "één woord"


def test_url_filter(spark):
    day = dt.date
    captures = spark.createDataFrame(
        [
            (1, "https://a.b.example.com/x/y?q", day(2024, 1, 1), "l"),
            (1, "https://a.b.example.com/x/y?q", day(2024, 1, 1), "l"),
            (2, "https://a.b.example.com/x/y?q", day(2024, 1, 31), "l"),
            (3, "HTTP://user@A.B.Example.com:80/", day(2024, 3, 1), "l"),
            (4, None, day(2024, 1, 2), "l"),
            (5, "https://a.b.example.com/", None, "l"),
            (None, "no url at all", day(2024, 1, 2), None),
            (6, "https://b.example.com/z", day(2024, 1, 2), "l"),
        ],
        "page_id long, url string, fetched date, lists string",
    )
    changes = spark.createDataFrame(
        [
            ("spam", "host", "a.b.example.com", "add", day(2024, 1, 1)),
            ("spam", "host", "a.b.example.com", "add", day(2024, 1, 5)),
            ("spam", "host", "a.b.example.com", "remove", day(2024, 1, 31)),
            ("spam", "host", "a.b.example.com", "add", day(2024, 2, 2)),
            ("spam", "host", "a.b.example.com", "add", day(2024, 2, 20)),
            ("spam", "host", "a.b.example.com", "remove", day(2024, 2, 20)),
            ("bad", "path", "a.b.example.com/x", "add", day(2023, 5, 5)),
            ("bad", "host", "b.example.com", "remove", day(2023, 5, 5)),
            ("bad", "host", "b.example.com", "add", day(2024, 1, 2)),
            (None, "host", "b.example.com", "add", day(2024, 1, 1)),
            ("bad", "host", None, "add", day(2024, 1, 1)),
            ("bad", "host", "b.example.com", "noise", day(2024, 1, 1)),
            ("bad", "host", "b.example.com", "add", None),
        ],
        "list string, kind string, pattern string, action string, day date",
    )
    out = urlfilter.judge(captures, changes).collect()
    got = sorted((str(r["page_id"]), r["blocked"], r["lists"], r["entries"], str(r["since"])) for r in out)
    assert got == [
        ("1", True, "bad,spam", 2, "2023-05-05"),
        ("1", True, "bad,spam", 2, "2023-05-05"),
        ("2", True, "bad", 2, "2023-05-05"),  # the path and the parent domain; spam ended that day
        ("3", True, "bad", 1, "2024-01-02"),
        ("4", False, "", 0, "None"),
        ("5", False, "", 0, "None"),
        ("6", True, "bad", 1, "2024-01-02"),
        ("None", False, "", 0, "None"),
    ]
    assert urlfilter.judge(captures.limit(0), changes).count() == 0
    assert urlfilter.judge(captures, changes.limit(0)).where("blocked").count() == 0


def test_minhash(docs, none):
    rows = minhash.near_duplicates(docs).collect()
    assert sorted((r["doc_id"] for r in rows), key=lambda x: (x is None, x)) == ALL_IDS
    got = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert got[2]["component_id"] == 1 and not got[2]["kept"]
    assert got[2**62]["component_id"] == 1  # 19 of 22 shingles shared
    assert got[4]["n_shingles"] == got[5]["n_shingles"] == got[3]["n_shingles"] == 0
    assert all(got[k]["kept"] and got[k]["component_id"] == k for k in (3, 4, 5, 6, 7, 8, -9))
    assert got[8]["n_shingles"] == 1
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert minhash.near_duplicates(none).count() == 0
    kept = minhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert _ids(kept) == [-9, 1, 3, 4, 5, 6, 7, 8, None, None]


def test_language_id(docs, none):
    rows = langid.op5_identify(docs).collect()
    assert len(rows) == len(ROWS)
    got = {r["doc_id"]: r for r in rows}
    for k in (3, 4, 5, 6):
        assert (got[k]["lang_pred"], got[k]["score"]) == ("und", 0.0)
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "nl", "und") for r in rows)
    assert langid.op5_identify(none).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.op5_identify(unlabelled).collect()} == {"und"}
    kept = langid.known_language(docs)
    assert kept.columns == docs.columns and 1 in _ids(kept) and 6 not in _ids(kept)


def test_html(spark):
    pages = spark.createDataFrame(
        [(1, "u", None, "t"), (1, "u", "", "t"), (None, None, "<p>x", "t"), (2, "u", "<p>" + LONG + "</p>", "t")],
        "page_id long, url string, html string, text string",
    )
    rows = htmltext.op6_extract(pages).collect()
    assert sorted(r["n_chars"] for r in rows) == [0, 0, 1, len(LONG)]
    assert htmltext.extract(pages).columns == ["page_id", "url", "text", "n_chars"]
    assert htmltext.op6_extract(pages.limit(0)).count() == 0


def test_mixing(docs, none):
    rows = mixing.op7_mix(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    assert sum(r["size"] for r in rows) == sum(len((r[1] or "").split()) for r in ROWS)
    assert mixing.op7_mix(none).count() == 0
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    copies = mixing.mix(docs, word_count(F.col("text")), tie=F.crc32(F.col("text").cast("binary")))
    assert mixed.count() == copies.agg(F.sum("copies")).first()[0] > 0
    assert copies.columns == [c for c in docs.columns if c not in ("size", "rank")] + [
        "size", "source_size", "target", "inclusion", "rank", "copies", "taken",
    ]


def test_spotsigs(docs, none):
    rows = spotsigs.likeness_to_next(docs).collect()
    assert sorted((r["doc_id"] for r in rows), key=lambda x: (x is None, x)) == ALL_IDS
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["near_next"] == 1.0 and by_id[1]["fingerprint"] == by_id[2]["fingerprint"] != ""
    assert by_id[4]["fingerprint"] == "" and by_id[4]["near_edited"] == 1.0
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert {r["near_next"] for r in rows if r["doc_id"] is None} == {0.0}
    assert spotsigs.likeness_to_next(none).count() == 0
    one = spotsigs.likeness_to_next(docs.where("doc_id = 1")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert spotsigs.similar_pairs(none).count() == 0
    assert {(r[0], r[1]) for r in spotsigs.similar_pairs(docs).collect()} >= {(1, 2)}


def test_ppm(docs, none):
    rows = ppm.op9_score(docs).collect()
    assert sorted((r["doc_id"] for r in rows), key=lambda x: (x is None, x)) == ALL_IDS
    got = {r["doc_id"]: r for r in rows}
    assert got[3]["n_tokens"] == got[4]["n_tokens"] == got[5]["n_tokens"] == 1
    assert all(r["score"] < 0 and r["base_score"] < 0 and r["n_known"] <= r["n_tokens"] for r in rows)
    twice = [r for r in rows if r["doc_id"] == 2]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert abs(twice[0]["score"] - got[1]["score"]) < 1e-9
    assert ppm.op9_score(none).count() == 0


def test_decontamination(spark, docs, none):
    bench = spark.createDataFrame(
        [(1, "the cat sat on the mat and the dog was in the house"), (2, None), (3, ""), (4, "!!!"), (5, "one two"), (None, "x y z")],
        "item_id long, text string",
    )
    assert sorted((r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, bench).collect()) == [
        (1, 1), (2, 1), (2, 1), (2**62, 1),
    ]
    clean = decontamination.decontaminated(docs, bench)
    assert clean.columns == docs.columns and _ids(clean) == [-9, 3, 4, 5, 6, 7, 8, None, None]
    assert decontamination.leaks(docs, bench.limit(0)).count() == 0
    assert decontamination.decontaminated(docs, bench.limit(0)).count() == len(ROWS)
    assert decontamination.leaks(none, bench).count() == 0
