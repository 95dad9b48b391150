"""Leaks in many documents, edited leaks against all alignments, and long items."""

from __future__ import annotations

import random

import numpy as np
import pytest

from pickmarts.llm import decontamination
from pickmarts.llm.textwords import NOT_ALNUM, texts_from_bytes, words_of

PARTS = {"truncated": (28, 0), "edited": (40, 4)}  # words of the item that stay, every how manieth is replaced


def _frame(spark, rows, names):
    return spark.createDataFrame(rows, names)


@pytest.mark.parametrize("kind", PARTS)
def test_leaks_in_a_third_of_the_documents(spark, kind):
    rng = random.Random(4)
    items = [[f"q{rng.randrange(10**6)}" for _ in range(40)] for _ in range(3)]
    stay, every = PARTS[kind]
    docs = []
    for d in range(900):
        filler = [f"f{rng.randrange(5000)}" for _ in range(60)]
        body = items[0][:stay] if d % 3 == 0 else []
        if every:
            body = ["new" if n % every == every - 1 else w for n, w in enumerate(body)]
        docs.append((d, " ".join([*filler[:30], *body, *filler[30:]])))
    found = decontamination.leaks(
        _frame(spark, docs, "doc_id long, text string"),
        _frame(spark, [(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string"),
    ).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(d, 0) for d in range(0, 900, 3)}
    assert {round(r["score"], 4) for r in found} == {0.7 if kind == "truncated" else 0.6375}


def _words(text: str):
    return words_of(texts_from_bytes([text.encode()]), lower=True, separators=NOT_ALNUM).hash


def _all_pairs(docs, items) -> dict:
    """Every document aligned whole with every segment of every item."""
    out = {}
    for d, text in docs:
        words = _words(text)
        for i, item in items:
            whole = _words(item)
            cuts = np.linspace(0, len(whole), -(-len(whole) // decontamination.SEGMENT) + 1).astype(int)
            for part in [whole[x:y] for x, y in zip(cuts[:-1], cuts[1:])]:
                if len(part) and len(words):
                    score = decontamination.align(part, words)[0] / (2 * len(part))
                    if score >= 0.5:
                        out[d, i] = max(score, out.get((d, i), 0))
    return out


def _edited(words: list[str], kind: str, rng: random.Random) -> list[str]:
    if kind == "foreign after every second":
        return [x for n, w in enumerate(words) for x in ([w, "zz"] if n % 2 else [w])]
    if kind == "every third replaced":
        return ["zz" if n % 3 == 2 else w for n, w in enumerate(words)]
    if kind == "every third dropped":
        return [w for n, w in enumerate(words) if n % 3 != 2]
    if kind == "half":
        return words[: len(words) // 2 + rng.randrange(-2, 3)]
    if kind == "random":
        return [rng.choice([w, w, w, "zz", ""]) for w in words]
    return words


KINDS = ["foreign after every second", "every third replaced", "every third dropped", "half", "random", "exact"]


@pytest.mark.parametrize("held", [0, decontamination.HELD_WORDS])
@pytest.mark.parametrize("vocabulary", [40, 3000])
def test_the_same_leaks_as_aligning_all_pairs(spark, vocabulary, held):
    """Also where no three words in a row survive, and where a few words make all texts."""
    rng = random.Random(vocabulary)
    word = lambda: f"w{int(vocabulary * rng.random() ** 2)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 5, 14, 40, 41, 59])))) for i in range(30)]
    items += [(100, " ".join(word() for _ in range(259)))]
    docs = []
    for d in range(150):
        kind = KINDS[d % len(KINDS)]
        body = _edited(items[d % len(items)][1].split(), kind, rng)
        filler = [word() for _ in range(rng.randrange(40))]
        docs.append((d, " ".join([*filler, *body, *[word() for _ in range(rng.randrange(80))]])))
    want = _all_pairs(docs, items)
    got = decontamination.leaks(
        _frame(spark, docs, "doc_id long, text string"), _frame(spark, items, "item_id long, text string"), held_words=held
    ).collect()
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in got} == want
    assert len(got) == len(want) > 60


def test_edits_that_leave_no_three_words_in_a_row(spark):
    rng = random.Random(8)
    item = [f"q{rng.randrange(10**6)}" for _ in range(40)]
    docs = [(d, " ".join(_edited(item, kind, rng))) for d, kind in enumerate(KINDS[:3])]
    got = decontamination.leaks(
        _frame(spark, docs, "doc_id long, text string"), _frame(spark, [(1, " ".join(item))], "item_id long, text string")
    ).collect()
    assert {r["doc_id"]: round(r["score"], 4) for r in got} == {0: 0.7625, 1: 0.5125, 2: 0.5125}


@pytest.mark.parametrize("held", [0, decontamination.HELD_WORDS])
def test_repeated_rows_and_clashing_columns(spark, held):
    item = " ".join(f"q{n}" for n in range(20))
    rows = [(1, item, "a", 1, "x"), (1, item, "b", 2, "y"), (None, item, None, None, None), (2, "clean text", "c", 3, "z")]
    docs = _frame(spark, rows, "doc_id long, text string, row string, item_id long, doc_id_7 string")
    bench = _frame(spark, [(5, item, 1), (5, item, 2), (None, item, 3), (6, None, 4), (7, "...", 5)], "item_id long, text string, part int")
    got = decontamination.leaks(docs, bench, held_words=held).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"], r["score"]) for r in got) == [(0, 5, 1.0), (1, 5, 1.0), (1, 5, 1.0)]
    assert [tuple(r) for r in decontamination.decontaminated(docs, bench, held_words=held).collect()] == [rows[3]]


def test_a_long_item_has_no_short_segment(spark):
    rng = random.Random(6)
    item = [f"q{rng.randrange(10**6)}" for _ in range(256)] + ["one", "of", "the"]
    filler = lambda n: [f"f{rng.randrange(5000)}" for _ in range(n)]
    docs = [
        (0, [*filler(30), "one", "of", "the", *filler(30)]),
        (1, [*filler(30), *item, *filler(30)]),
        (2, [*filler(30), *item[120:], *filler(30)]),  # its second half
        (3, filler(60)),
    ]
    docs = _frame(spark, [(d, " ".join(w)) for d, w in docs], "doc_id long, text string")
    bench = _frame(spark, [(7, " ".join(item))], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontamination.leaks(docs, bench).collect()) == [1, 2]
    assert sorted(r["doc_id"] for r in decontamination.decontaminated(docs, bench).collect()) == [0, 3]
    sizes = (0, 1, 2, 3, 255, 256, 257, 259, 512, 513, 5000)
    texts = _frame(spark, [(n, " ".join(f"w{k}" for k in range(n))) for n in sizes], "item_id long, text string")
    parts: dict = {n: [] for n in sizes}
    for r in decontamination.segments_of(texts).collect():
        parts[r["item_id"]].append(len(r["words"]))
    for n, p in parts.items():
        assert sum(p) == n and len(p) == -(-n // 256) and (not n or max(p) - min(p) <= 1)
