"""Operator 11 against all substrings of all texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pickmarts.llm.columns import Scratch
from pickmarts.llm.suffixes import Lengths, dedup_bytes, op11_dedup, pieces, reranked
from pickmarts.llm.textwords import texts_from_bytes

SHORT = Lengths(threshold=16, first=4, coarse=8, fine=14, piece=70)


def brute(texts: list[bytes], size: int) -> list[tuple]:
    seen = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        spans = [i for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1])]
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), len(spans), hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, rows, lengths, columns="doc_id long, text string"):
    df = spark.createDataFrame(rows, columns).repartition(3)
    want = brute([(r[1] or "").encode() for r in rows], lengths.threshold)
    got = op11_dedup(df, lengths)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((r[0], *w)) for r, w in zip(rows, want))
    return want


@pytest.mark.parametrize("seed", [1, 2])
def test_all_substrings(spark, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé") for _ in range(rng.randrange(5, 60))) for _ in range(8)]
    rows = []
    for i in range(120):
        parts = [
            rng.choice(base)[rng.randrange(4) : rng.randrange(8, 60)] + rng.choice(["", "x", "yz", str(rng.random())])
            for _ in range(rng.randrange(8))
        ]
        rows.append((rng.choice([i, None, 7]), "".join(parts) if i % 20 else None))
    # runs of one byte and of a period, in one text and twice; repeated rows; texts of one string, and less
    rows += [(1, "a" * 100), (1, "a" * 100), (2, "a" * 50), (3, "ab" * 60), (4, "0123456789abcdef"), (5, "0123456789abcde"), (6, "")]
    want = check(spark, rows, SHORT)
    assert 0 < sum(w[1] for w in want) < sum(w[0] for w in want)


def test_hot_text_and_odd_columns(spark):
    rng = random.Random(5)
    hot = "".join(rng.choice("abcdefgh") for _ in range(300))
    rows = [(9, hot, "x", 1, 2)] * 40  # one row, a third of the table
    rows += [(i, hot[rng.randrange(300) :] + str(rng.random()) * 3, None, None, i) for i in range(80)]
    check(spark, rows, SHORT, "doc_id long, text string, anchor string, row int, spans long")


def test_production_lengths(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    shared = " ".join(word() for _ in range(90))
    rows = []
    for i in range(30):
        cut = rng.choice([397, 398, 401, 450])  # with both marks: just short of a string, one, more
        rows.append((i, word() + f"{i}<" + shared[i % 3 : i % 3 + cut] + f">{i}" + " ".join(word() for _ in range(60))))
    long = "é".join(" ".join(word() for _ in range(40)) for _ in range(30))
    rows += [(100, long * 2), (101, long[5:]), (102, None)]
    want = check(spark, rows, Lengths())
    assert any(w[1] for w in want[:30]) and any(not w[1] for w in want[:30])


def test_empty_table_and_general_output(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert op11_dedup(empty).collect() == []
    df = spark.createDataFrame([("a", "0123456789abcdefXY"), ("b", "..0123456789abcdef")], "doc_id string, text string")
    got = {r["doc_id"]: r for r in dedup_bytes(df, SHORT).collect()}
    assert [tuple(s) for s in got["a"]["spans"]] == [(0, 16)] and got["a"]["kept"] == b"XY"
    assert [tuple(s) for s in got["b"]["spans"]] == [(2, 18)] and got["b"]["kept"] == b".."


def test_a_very_long_text(spark):
    """6 MB in one row, a megabyte of it twice, far apart."""
    rng = np.random.default_rng(3)
    data = rng.integers(97, 123, 5_000_000, dtype=np.uint8).tobytes().decode()
    text = data[:3_000_000] + data[:1_000_000] + data[3_000_000:]
    got = op11_dedup(spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")).orderBy("doc_id").collect()
    assert got[0]["n_bytes"] == 6_000_000
    # a border byte may agree by chance
    assert 2_000_000 <= got[0]["n_removed"] <= 2_000_020 and got[0]["n_spans"] == 2
    assert tuple(got[1])[1:4] == (5, 0, 0)


def test_every_string_lies_in_one_piece():
    texts = texts_from_bytes([b"a" * 5, b"", b"b" * 200, b"c" * 16, b"d" * 70, b"e" * 71])
    strings = Counter()
    for p in pieces(texts, SHORT):
        assert len(p.data) <= SHORT.piece + SHORT.threshold - 1
        text, start = p.strings(SHORT.threshold)
        for t, s in zip(p.rows[text].tolist(), (start - p.offsets[text] + p.base).tolist()):
            strings[t, s] += 1
    assert set(strings.values()) == {1}
    assert len(strings) == 185 + 1 + 55 + 56


def test_ranks_across_the_borders_of_tasks(spark):
    """Few different pairs over many tasks: runs cross tasks, whole tasks hold one run, some pairs stand once."""
    rows = [(k, 1, 5 if i < 50 else 6, i, 0, 0) for k in (1, 2) for i in range(60)] + [(3, i, i, 0, 0, 0) for i in range(40)]
    schema = "anchor long, a long, b long, name long, start int, part int"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    try:
        df = spark.createDataFrame(rows, schema)
        got = reranked(df, Scratch(spark, "test"), "ranks").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ranks: dict = {}
    for r in got:
        ranks.setdefault(r["rank"], set()).add((r["anchor"], r["name"]))
    want = [{(k, i) for i in span} for k in (1, 2) for span in (range(50), range(50, 60))]
    assert sorted(map(sorted, ranks.values())) == sorted(map(sorted, want))


def test_lengths_must_fit():
    for bad in (dict(threshold=300), dict(threshold=100), dict(coarse=360), dict(fine=401)):
        with pytest.raises(ValueError):
            Lengths(**bad)
