"""Results against SQL, brute force, exact copies and held-out accuracy."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
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
)
from pickmarts.llm.columns import read_table
from pickmarts.llm.components import components
from pickmarts.llm.queries import llm_oracle, llm_queries
from pickmarts.llm.textwords import distinct_per_text, ngram_hashes, texts_from_bytes, words_of

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    df = read_table(spark, SMALL, "documents").cache()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.collect()}


def _shingles(text: str) -> set:
    w = text.encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))}


def _groups(texts: dict[int, str]) -> dict[int, int]:
    """Component of every document by comparing all pairs."""
    sets = {d: _shingles(t) for d, t in texts.items()}
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                c = len(x & y)
                if 100 * c >= 75 * (len(x) + len(y) - c):
                    ra, rb = find(a), find(b)
                    root[max(ra, rb)] = min(ra, rb)
    return {d: find(d) for d in ids}


@pytest.mark.parametrize("name", sorted(llm_oracle()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = con.sql(llm_oracle()[name])
    got = llm_queries()[name](spark, SMALL).select(*want.columns)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want.fetchall(), key=key)


# --- words ---------------------------------------------------------------------


def test_words_are_those_of_split():
    rng = random.Random(3)
    alphabet = "ab é\t\n\x0b\x0c\r \x00\xa0ß日"
    parts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)]
    words = words_of(texts_from_bytes([p.encode() for p in parts]), lower=True)
    seen: dict[bytes, int] = {}
    for i, p in enumerate(parts):
        split = p.encode().lower().split()
        hashes = words.hash[words.first[i] : words.first[i + 1]].tolist()
        assert len(hashes) == len(split)
        assert all(seen.setdefault(w, h) == h for w, h in zip(split, hashes))
    assert len(set(seen.values())) == len(seen)


# --- 1 sharding ------------------------------------------------------------------


def test_changed_weight_moves_rows_only_into_the_grown_subtree(spark):
    ids = spark.range(20000).withColumnRenamed("id", "doc_id")
    tree = sharding.Tree.regular()
    heavier = tree.reweighted(7, 3.0)  # shard 7: rack-1 of region-0
    rows = ids.select(
        sharding.shard_of(ids["doc_id"], tree).alias("a"),
        sharding.shard_of(ids["doc_id"], heavier).alias("b"),
        sharding.shard_of(ids["doc_id"], sharding.Tree.regular(41)).alias("c"),
        sharding.shard_of(ids["doc_id"], sharding.Tree.regular(42)).alias("d"),
    ).collect()
    region, rack = (lambda s: s // 20), (lambda s: s // 4)
    for r in rows:
        if r["a"] != r["b"]:
            # into the grown region, or inside it into the grown rack, or inside that into the shard
            assert region(r["b"]) == 0
            assert region(r["a"]) != 0 or rack(r["b"]) == 1
            assert rack(r["a"]) != 1 or r["b"] == 7
        assert r["c"] in (r["a"], 40) and r["d"] in (r["c"], 41)
    sizes = Counter(r["a"] for r in rows)
    assert len(sizes) == 40 and 350 < min(sizes.values()) and max(sizes.values()) < 650
    grown = Counter(r["b"] for r in rows)
    assert 2.2 < grown[7] / (sum(grown.values()) - grown[7]) * 39 < 4


# --- 2 substring dedup -----------------------------------------------------------


def test_hot_anchors_are_cut_anew_and_searched_too(spark, monkeypatch):
    df = read_table(spark, SMALL, "documents")
    plain = {tuple(r) for r in fmindex.op2_dedup(df).collect()}
    monkeypatch.setattr(fmindex, "HOT_PASSAGES", 1)
    assert {tuple(r) for r in fmindex.op2_dedup(df).collect()} == plain


def test_a_phrase_in_most_documents_overflows_no_shard(spark, monkeypatch):
    rng = random.Random(3)
    some = [f"w{k}" for k in range(40)]
    phrase = "all rights reserved by the owners of this page and its authors in full".split()
    texts = {}
    for d in range(300):
        # 4, 8 or 14 words of the phrase between words of its own, so that anchors of every length are hot
        n = rng.choice((4, 8, 14))
        texts[d] = rng.choices(some, k=rng.randint(6, 14)) + phrase[:n] + rng.choices(some, k=rng.randint(6, 14))
    for d in range(300, 330):
        texts[d] = texts[d - 300] + rng.choices(some, k=3)
    first: dict[tuple, int] = {}
    for d, w in texts.items():
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), d)
    want = {}
    for d, w in texts.items():
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < d for j in range(13)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    assert sum(n > 0 for _, n, _ in want.values()) > 100
    monkeypatch.setattr(fmindex, "HOT_PASSAGES", 8)
    monkeypatch.setattr(fmindex, "SHARD_WORDS", 64)
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in texts.items()], "doc_id long, text string")
    got = {r[0]: (r[1], r[2], r[3]) for r in fmindex.op2_dedup(df).collect()}
    assert got == want


def test_matching_statistics_against_brute_force():
    rng = np.random.default_rng(11)
    text = np.append(rng.integers(1, 4, 120), 0)
    index = fmindex.FMIndex(text)
    starts = np.arange(len(text) - 13)
    statistic, lo, hi = index.search(text[starts[:, None] + np.arange(13)])
    everywhere = text.tolist()

    def times(run):
        return sum(everywhere[k : k + len(run)] == run for k in range(len(everywhere) - len(run) + 1))

    for s, m, a, b in zip(starts, statistic, lo, hi):
        window = everywhere[s : s + 13]
        assert m == max([k for k in range(1, 14) if times(window[-k:]) > 1], default=0)
        assert b - a == (times(window) if m == 13 else 1)


def test_backward_search_finds_every_window():
    rng = np.random.default_rng(5)
    base = [rng.integers(0, 4, 30).astype(np.uint64) for _ in range(6)]
    passages = [b[i : i + n] for b in base for i, n in ((0, 13), (3, 20), (3, 20), (8, 22))]
    least = rng.permutation(len(passages)).astype(np.int64)
    want: dict[bytes, int] = {}
    for p, d in zip(passages, least):
        for k in range(len(p) - 12):
            w = p[k : k + 13].tobytes()
            want[w] = min(want.get(w, 10**9), int(d))
    got = fmindex.window_minima(passages, least)
    for p, g in zip(passages, got):
        assert g.tolist() == [want[p[k : k + 13].tobytes()] for k in range(len(p) - 12)]


# --- 4 near duplicates -----------------------------------------------------------


def test_links_that_no_star_centre_has_are_found(spark, monkeypatch):
    # chains of edits: neighbours are linked, the ends are not; with coarse bands everything shares buckets
    rng = random.Random(11)
    texts, n = {}, 0
    for _ in range(6):
        words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
        for _ in range(12):
            texts[n] = " ".join(words)
            n += 1
            at = rng.randrange(115)
            words = words[:at] + [f"v{rng.randrange(10**6)}"] + words[at + 1 :]
    monkeypatch.setattr(minhash, "ROWS", 1)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = minhash.near_duplicates(df).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == _groups(texts)


def test_sketch_coordinates_agree_like_the_sets():
    rng = np.random.default_rng(2)
    for size, shared in ((6, 4), (60, 45), (3000, 2400)):
        pool = rng.integers(0, 2**63, 2 * size - shared).astype(np.uint64)
        a, b = np.sort(pool[:size]), np.sort(pool[size - shared :])
        doc = np.repeat([0, 1], size)
        s = minhash.sketches(np.concatenate([a, b]), doc, 2, 720)
        assert (s != np.uint64(2**64 - 1)).all()
        truth = shared / (2 * size - shared)
        assert abs((s[0] == s[1]).mean() - truth) < 5 * math.sqrt(truth * (1 - truth) / 720)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(200, 202), (202, 201), (201, 200)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    edges = [e for e in edges if e[0] != e[1]]
    rng.shuffle(edges)
    root = {x: x for e in edges for x in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(edges, "u long, v long"))
    assert {r["u"]: r["v"] for r in got.collect()} == {x: r for x, r in root.items() if x != r}


# --- 5 language ------------------------------------------------------------------


def test_language_on_held_out_documents(spark):
    df = read_table(spark, MIDDLE, "documents")
    truth = {r["doc_id"]: r["lang"] for r in df.select("doc_id", "lang").collect()}
    rows = [r for r in langid.op5_identify(df).collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows)
    sure = [r for r in rows if r["lang_pred"] != "und"]
    assert len(sure) > 0.98 * len(rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in sure) > 0.97 * len(sure)


# --- 6 html ------------------------------------------------------------------------


def test_article_text_is_whole(spark):
    pages = {r["page_id"]: r["html"] for r in read_table(spark, SMALL, "pages").collect()}
    for r in llm_queries()["op6_html_text"](spark, SMALL).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        want = " ".join(htmltext.htmllib.unescape(re.sub(r"</?[a-z][^>]*>", " ", article)).split())
        assert r["text"] == want and r["n_chars"] == len(want)


SENTENCE = "It was the best of times and it was the worst of times for all of us in the city. "


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p>one<p>two &amp; three", "one two & three"),
        ("<article>a &lt;b&gt;&nbsp;c<script>x='</p>'</script><style>y</style></article>", "a <b> c"),
        ("<article><p>x</p><div class='comments'><p>bad</p></div><p>y</p></article><p>after", "x y"),
        ("<article><p>we<b>b</b></p><ul><li><a href=1>link one</a></ul></article>", "web"),
        ("<body><header>site</header><main><header><h1>T</h1></header><p>b</main><aside>no</aside>", "T b"),
        (f"<div id=sideBar>{SENTENCE * 5}</div><div><h1>Head</h1><p>{SENTENCE * 4}</p><p>End.</p></div>", f"Head {SENTENCE * 4}End."),
        ("<form><p>name</p></form><div role=navigation>m</div><div hidden>h</div><p>t", "t"),
        ("<article><p>1 < 2 and a<!-- <p>c</p> -->b</p></article>", "1 < 2 and ab"),
        ("<article><table><tr><td>a<td>b</table><pre>x\n  y</pre></article><div class=ad>buy</div>", "a b x y"),
    ],
)
def test_html_cases(page, want):
    assert htmltext.main_text(page) == " ".join(want.split())


# --- 7 mixing ------------------------------------------------------------------------


def test_each_source_meets_its_target(spark):
    rows = mixing.op7_mix(read_table(spark, MIDDLE, "documents")).collect()
    source = {r["doc_id"]: r["source"] for r in read_table(spark, MIDDLE, "documents").collect()}
    taken, target, size, largest = Counter(), {}, {}, Counter()
    for r in rows:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        target[s], size[s] = r["target"], r["source_size"]
        largest[s] = max(largest[s], r["size"])
        assert r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 2 * r["size"]
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-3
    for s in target:
        assert target[s] <= 2 * size[s] + 1e-6
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1


# --- 8 fingerprints ------------------------------------------------------------------


@pytest.mark.parametrize("docs_per_range, chunk", [(2048, 2 << 20), (30, 5000)])
def test_likeness_to_next(documents, texts, monkeypatch, docs_per_range, chunk):
    monkeypatch.setattr(spotsigs, "DOCS_PER_RANGE", docs_per_range)
    got = {r["doc_id"]: r for r in spotsigs.likeness_to_next(documents).collect()}
    ids = sorted(texts)
    for i, d in enumerate(ids):
        t, after = texts[d], texts[ids[(i + 1) % len(ids)]]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        a, b, c = (_elements(x) for x in (t, edited, after))
        r = got[d]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and r["n_chars"] == len(t)
        assert r["near_edited"] == pytest.approx(_likeness(a, b)) and r["near_next"] == pytest.approx(_likeness(a, c))
        assert len(r["fingerprint"]) == 8 * len(a)


def _elements(text: str) -> Counter:
    words = re.findall(rb"[a-z0-9\x80-\xff]+", text.encode().lower())
    words = [w.decode("utf-8", "replace") for w in words]
    stops, found = htmltext.STOP_WORDS | set(spotsigs.ANCHORS), []
    content = [i for i, w in enumerate(words) if w not in stops]
    for i, w in enumerate(words):
        if w in spotsigs.ANCHORS:
            chain = [words[j] for j in content if j > i][: spotsigs.CHAIN]
            if len(chain) == spotsigs.CHAIN:
                found.append((w, *chain))
    if not found and words:
        found = [tuple(words)]
    return {(s, k) for s, n in Counter(found).items() for k in range(n)}


def _likeness(a, b) -> float:
    return len(a & b) / len(a | b) if a or b else 1.0


def test_similar_pairs_are_all_pairs(documents, texts):
    least = 0.4
    got = {(r[0], r[1]): r[2] for r in spotsigs.similar_pairs(documents, least).collect()}
    first: dict[frozenset, int] = {}
    want = {}
    for d in sorted(texts):
        e = frozenset(_elements(texts[d]))
        if e in first:
            want[(first[e], d)] = 1.0
        elif e:
            for f, x in first.items():
                if _likeness(e, f) >= least:
                    want[(x, d)] = _likeness(e, f)
            first[e] = d
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)


# --- 9 language model ----------------------------------------------------------------


def test_ppm_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ppm, "COMMON", 300)
    monkeypatch.setattr(ppm, "KINDS", 3)
    monkeypatch.setattr(ppm, "TASK_WORDS", 500)
    df = read_table(spark, SMALL, "documents")
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in df.collect()]
    got = {r["doc_id"]: r for r in ppm.op9_score(df).collect()}
    learn = [(t.encode().lower().split(), kind) for d, t, kind in docs if zlib.crc32(str(d).encode()) % 10]
    common = [k for k, _ in sorted(Counter(k for _, k in learn).items(), key=lambda x: (-x[1], x[0]))][:2]
    tries = []
    for kind in (*common, None):
        own = [w for w, k in learn if k == kind or (kind is None and k not in common)]
        trie = defaultdict(Counter)
        for words in own:
            for w in words:
                s = b" " + w + b" "
                for i in range(1, len(s)):
                    for k in range(min(i, ppm.ORDER) + 1):
                        trie[s[i - k : i]][s[i]] += 1
            for a, b in zip(words, [*words[1:], None]):
                trie[a[-1:] + b" "][256 if b is None else b[0]] += 1
        trie[b""][256] += len(own)
        trie[b" "][256] += len(own)
        tries.append((trie, len(own)))

    def code(trie, context, symbol):
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

    counts = Counter(w for words, _ in learn for w in words)
    total, distinct = sum(counts.values()) + len(learn), len(counts) + 1
    norm = math.log10(total + 0.1 * (distinct + 1))
    memo: dict = {}
    for d, t, _ in random.Random(4).sample(docs, 60):
        words = t.encode().lower().split()
        r = got[d]
        assert r["n_tokens"] == len(words) + 1 and r["train_tokens"] == total
        assert r["n_known"] == sum(w in counts for w in words) + 1
        base = sum(math.log10(counts[w] + 0.1) for w in words) + math.log10(len(learn) + 0.1) - norm * (len(words) + 1)
        assert r["base_score"] == pytest.approx(base)
        each = []
        for i, (trie, n) in enumerate(tries):
            for w in set(words):
                if (i, w) not in memo:
                    s = b" " + w + b" "
                    memo[i, w] = sum(code(trie, s[:k], s[k]) for k in range(2, len(s)))
            # a word's first byte and the end mark see the last byte of the word before
            before = [b" ", *[w[-1:] + b" " for w in words]]
            crossed = [code(trie, a, b) for a, b in zip(before, [*[w[0] for w in words], 256])]
            each.append(sum(memo[i, w] for w in words) + sum(crossed) + math.log10(n / len(learn)))
        best = max(each)
        assert r["score"] == pytest.approx(best + math.log10(sum(10 ** (x - best) for x in each)))


# --- 10 decontamination ----------------------------------------------------------------


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(8)
    for _ in range(60):
        a, b = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 18))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                step = 2 if a[i] == b[j] else -1
                h[i + 1, j + 1] = max(0, h[i, j] + step, h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert decontamination.align(a, b)[0] == h.max()


def test_edited_copies_leak_and_shared_runs_do_not(spark):
    rng = random.Random(9)
    bench = [(i, [f"q{rng.randrange(5000)}" for _ in range(rng.randrange(15, 50))]) for i in range(40)]
    docs, edited, clean = [], set(), set()
    for i, words in bench:
        for kind in range(3):
            filler = [f"f{rng.randrange(5000)}" for _ in range(80)]
            body = list(words)
            if kind == 0:  # a fifth of the words changed, dropped or preceded by a new one
                body = [
                    x
                    for w in body
                    for x in ([w] if rng.random() > 0.15 else rng.choice(([], ["new"], ["new", w])))
                ]
            elif kind == 1:  # a third of the item only
                body = body[: len(body) // 3]
            d = len(docs)
            (clean if kind == 1 else edited).add((d, i))
            docs.append((d, " ".join([*filler[:40], *body, *filler[40:]]).upper()))
    found = decontamination.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(w)) for i, w in bench], "item_id long, text string"),
    )
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert not got & clean and len(got & edited) >= 0.97 * len(edited) and got <= edited


def test_exact_passages_of_the_benchmark(spark, texts):
    items = {r["item_id"]: r["text"] for r in read_table(spark, SMALL, "benchmark").collect()}
    found = {(r["doc_id"], r["item_id"]) for r in llm_queries()["op10_decontamination"](spark, SMALL).collect()}
    plain = lambda t: " ".join(re.findall(r"[a-z0-9]+|[^\x00-\x7f]+", t.lower()))
    exact = {(d, i) for d, t in texts.items() for i, x in items.items() if f" {plain(x)} " in f" {plain(t)} "}
    assert exact and exact <= found and len(found - exact) <= 0.1 * len(exact) + 1


# --- pipeline ----------------------------------------------------------------------------


def test_pipeline_stages(spark, documents, texts):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_dedup", "benchmark_decontamination", "mixing", "sharding",
    ]
    docs, kept, cached = documents, {}, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL).cache()
        cached.append(docs)
        kept[name] = [r["doc_id"] for r in docs.select("doc_id").collect()]
        if name != "sharding":
            assert docs.columns == documents.columns
    lettered = {d for d, t in texts.items() if any(c.isalpha() for c in t)}
    assert len(set(kept["language_id"]) & lettered) >= 0.99 * len(lettered) and set(kept["language_id"]) <= lettered
    groups = _groups({d: texts[d] for d in kept["language_id"]})
    assert sorted(kept["near_dedup"]) == sorted(set(groups.values()))
    assert set(kept["benchmark_decontamination"]) <= set(kept["near_dedup"])
    mixed = Counter(kept["mixing"])
    assert set(mixed) <= set(kept["benchmark_decontamination"]) and max(mixed.values()) <= 2
    rows = docs.collect()
    assert Counter(r["doc_id"] for r in rows) == mixed
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["text"] == texts[r["doc_id"]]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    for df in cached:
        df.unpersist()


def test_short_ngrams_and_distinct():
    words = words_of(texts_from_bytes([b"a b c", b"", b"a b c d e f", b"a b c d e a b c d e"]), lower=True)
    h, doc, _ = ngram_hashes(words, 5, short_whole=True)
    assert Counter(doc.tolist()) == {0: 1, 2: 2, 3: 6}
    _, owner = distinct_per_text(h, doc, 4)
    assert Counter(owner.tolist()) == {0: 1, 2: 2, 3: 5}
