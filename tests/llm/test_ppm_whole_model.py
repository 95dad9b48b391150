"""The model keeps every node, however many there are."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pyarrow as pa
import pytest

from pickmarts.llm import ppm
from pickmarts.session import checkpoint_dir


def test_more_nodes_than_one_task_should_hold(spark):
    rng = random.Random(11)
    # random words: about 15 new nodes each, 3 million in all
    texts = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=10)) for _ in range(1000)) for _ in range(220)]
    held = next(d for d in range(len(texts)) if not zlib.crc32(str(d).encode()) % 10)
    taught = [d for d in range(len(texts)) if zlib.crc32(str(d).encode()) % 10]
    texts[held] = " ".join(texts[taught[0]].split()[:20] + texts[held].split()[:20])
    asked = [b" " + w.encode() + b" " for w in texts[held].split()]
    wanted = {s[i - k : i] for s in asked for i in range(1, len(s)) for k in range(min(i, ppm.ORDER) + 1)}
    trie, nodes = defaultdict(Counter), set()
    for d in taught:
        for w in texts[d].split():
            s = b" " + w.encode() + b" "
            for i in range(1, len(s)):
                for k in range(min(i, ppm.ORDER) + 1):
                    nodes.add(s[i - k : i + 1])
                    if s[i - k : i] in wanted:
                        trie[s[i - k : i]][s[i]] += 1
    assert len(nodes) > 2_000_000
    for d in taught:
        ends = [w.encode()[-1:] + b" " for w in texts[d].split()]
        for context, after in zip(ends, [*[w.encode()[0] for w in texts[d].split()[1:]], 256]):
            trie[context][after] += 1
    for c in (b"", b" "):
        trie[c][256] += len(taught)

    def code(context, symbol):
        gone, out = set(), 0.0
        for k in range(min(ppm.ORDER, len(context)), -1, -1):
            seen = {s: c for s, c in trie.get(context[len(context) - k :], {}).items() if s not in gone}
            if seen:
                total = 2 * sum(seen.values())
                if symbol in seen:
                    return out + math.log10((2 * seen[symbol] - 1) / total)
                out += math.log10(len(seen) / total)
                gone |= set(seen)
        return out - math.log10(257 - len(gone))

    df = spark.createDataFrame([(d, t, "x") for d, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = ppm.op9_score(df).where(f"doc_id = {held}").first()["score"]
    want = sum(code(s[:i], s[i]) for s in asked for i in range(2, len(s))) + code(b" ", asked[0][1])
    want += sum(code(a[-2:], b[1]) for a, b in zip(asked, asked[1:])) + code(asked[-1][-2:], 256)
    assert got == pytest.approx(want)


def test_word_order_counts(spark):
    """Texts whose words follow one another by their letters score higher than the same words shuffled."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(400)]
    by_first = defaultdict(list)
    for w in words:
        by_first[w[0]].append(w)
    texts = []
    for _ in range(300):
        text = [rng.choice(words)]
        while len(text) < 60:
            text.append(rng.choice(by_first[text[-1][-1]]))
        texts.append(text)
    rows = [(d, " ".join(t), "x") for d, t in enumerate(texts)]
    rows += [(1000 + d, " ".join(rng.sample(t, len(t))), "x") for d, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sums, _ = ppm.score(df, df["doc_id"] < 200)  # learns from 200 of the ordered texts
    got = {r["doc_id"]: r["score"] for r in sums.collect()}
    assert all(got[d] > got[1000 + d] + 5 for d in range(200, 300))
    # texts of the same words and borders score alike, whatever the case
    same = spark.createDataFrame([(0, "ab ab AB", "x"), (1, "AB ab ab", "x"), (2, "ab", "x")], df.schema)
    alike = {r["doc_id"]: r["score"] for r in ppm.score(same, same["doc_id"] >= 0)[0].collect()}
    assert alike[0] == pytest.approx(alike[1])


def test_intermediate_tables_go(spark):
    folder = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.glob("ppm-*/*"))
    df = spark.createDataFrame([(d, f"some words of text {d}", "x") for d in range(50)], "doc_id long, text string, lang string")
    assert ppm.op9_score(df).count() == 50
    left = {p.name for p in set(folder.glob("ppm-*/*")) - before}
    assert left == {"entries", "local"}


def test_counts_of_a_word_are_not_carried_by_its_symbols():
    """A symbol's row is the hash of its word and its slot; the counts come once a word."""
    words = pa.array([b"ab", b"abc"], pa.binary())
    batch = pa.RecordBatch.from_arrays([words, pa.array([3, 4]), pa.array([5, 6])], names=["word", "learned", "uses"])
    spelled = next(ppm._spelled_batches(iter([batch.select(["word"])])))
    assert spelled.schema.names == ["hash", "slot"] and spelled.num_rows == 3 + 4
    counted = next(ppm._hashed_batches(iter([batch])))
    assert counted.schema.names == ["hash", "learned", "uses"] and counted.num_rows == 2
    assert set(counted.column(0).to_pylist()) == set(spelled.column(0).to_pylist())
