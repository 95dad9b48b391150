"""Operator 12 against trees built level by level."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from pickmarts.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(digests: list[str]) -> list[list[str]]:
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    out = []
    for level in levels[:-1]:
        run = range(i // 16 * 16, min(i // 16 * 16 + 16, len(level)))
        out.append(("".join(level[k] for k in run if k < i), "".join(level[k] for k in run if k > i)))
        i //= 16
    return out


def brute(rows: list[tuple]) -> tuple[list[tuple], dict]:
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sources: dict = {}
    for r in rows:
        leaf = tampered = h(*map(field, r))
        if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0:
            tampered = h(*map(field, (*r[:4], None if r[4] is None else r[4].translate(lower))))
        sources.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf, tampered, r[0]))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        sources[s].sort(key=lambda x: x[:3])
    trees = {s: tree([x[2] for x in sources[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names]) if names else [[""]]
    out = []
    for j, s in enumerate(names):
        for i, x in enumerate(sources[s]):
            siblings = path(trees[s], i) + path(top, j)
            digest = x[3]
            for left, right in siblings:
                digest = h(left, digest, right)
            proof = h(*(a + b for a, b in siblings))
            out.append((x[4], x[2], trees[s][-1][0], top[-1][0], proof, digest, digest == top[-1][0]))
    return out, trees


def check(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema).repartition(5)
    got = merkle.op12_manifest(df)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want, trees = brute([tuple(r)[:5] for r in rows])
    got = got.collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    return df, got, trees


def logs_match(df, trees):
    logs: dict = {}
    for r in merkle.manifest_log(df).collect():
        logs.setdefault(r["source"], []).append((r["place"], r["level"], r["digest"]))
    assert set(logs) == set(trees)
    for source, log in logs.items():
        log.sort()
        assert [p for p, _, _ in log] == list(range(len(log)))  # gapless: the closed form is the appending order
        for level, nodes in enumerate(trees[source]):
            assert [d for _, k, d in log if k == level] == nodes
        # postorder: a node follows its last child
        for p, k, _ in log:
            assert k == 0 or log[p - 1][1] == k - 1


def test_sources_of_many_sizes(spark):
    rng = random.Random(1)
    sizes = {None: 3, "": 1, "a": 1, "b": 2, "c": 16, "d": 17, "e": 256, "f": 257, "Z": 33, "é": 40}
    sizes |= {f"host{i}": 1 + i % 3 for i in range(300)}  # more than 256 sources
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            i += 1
            text = rng.choice([None, "", "Mixed Case ÄÖ", "lower", f"UPPER {i}"])
            rows.append((rng.choice([i, -i]), source, rng.choice([None, "de"]), rng.choice([None, i]), text))
    df, got, trees = check(spark, rows)
    assert not all(r["verified"] for r in got) and any(r["verified"] for r in got)
    logs_match(df, trees)


def test_more_leaves_than_a_block(spark):
    rows = [(i, "big", "en", i, f"Text {i}") for i in range(merkle.BLOCK * 2 + 18)] + [(1, "s", None, None, None)]
    df, _, trees = check(spark, rows)
    assert len(trees["big"]) == 5
    logs_match(df, trees)


def test_exactly_one_block(spark):
    df, _, trees = check(spark, [(i, "x", "en", i, "T") for i in range(merkle.BLOCK)])
    logs_match(df, trees)


def test_more_sources_than_a_block(spark):
    check(spark, [(i, f"s{i % 5000}", "en", i, "T") for i in range(6000)])


def test_null_equal_and_repeated_ids_and_clashing_columns(spark):
    rows = [(None, "a", None, None, None, "t", 1, "x")] * 3 + [(None, "a", None, None, "B", "t", 1, "x")]
    rows += [(7, "a", "en", 1, "Same", "t", None, None)] * 30 + [(7, "a", "en", 1, f"Other {i}", "t", 2, "y") for i in range(5)]
    check(spark, rows, SCHEMA + ", tree string, n long, digest string")


def test_empty_table_and_one_row(spark):
    assert merkle.op12_manifest(spark.createDataFrame([], SCHEMA)).collect() == []
    assert merkle.manifest_log(spark.createDataFrame([], SCHEMA)).collect() == []
    _, got, _ = check(spark, [(5, "a", None, 2, "Ab")])
    assert got[0]["leaf"] == got[0]["subroot"] == got[0]["root"] and got[0]["proof_sha256"] == h("")


def test_a_very_long_text(spark):
    check(spark, [(1, "a", "en", 1, "Word " * 1_000_000), (2, "a", "en", 1, "B")])


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 300, 4096])
def test_places_are_those_of_an_appender(n):
    levels = merkle.height(n)
    log = merkle.block_log([str(i) for i in range(n)], levels)
    whole = tree([str(i) for i in range(n)])
    assert len(log) == sum(map(len, whole)) == merkle.place(levels, n - 1) + 1
    for level, nodes in enumerate(whole):
        for j, digest in enumerate(nodes):
            assert log[merkle.place(level, min((j + 1) * 16**level, n) - 1)] == digest
    for leaf in {0, n // 2, n - 1}:
        assert merkle.siblings(log, n, levels, leaf) == path(whole, leaf)
        assert merkle.folded(str(leaf), path(whole, leaf)) == whole[-1][0]
