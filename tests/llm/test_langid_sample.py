"""Operator 5: which rows teach, the gate, and the network against plain loops."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pickmarts.llm import langid

SCHEMA = "doc_id long, text string, lang string"


def _sample(df):
    windows, labels, langs = langid.sample_windows(df, "text", "lang", F.col("doc_id"))
    return [(langs[k], w.tobytes()) for w, k in zip(windows, labels)], langs


def test_sample_is_a_function_of_the_table(spark):
    """Rows without ids and a frequent language leave the others their part, in any order of the rows."""
    rows = [(None, f"english text number {i} of many", "en") for i in range(6000)]
    rows += [(None, f"deutscher satz nummer {i} von vielen", "de") for i in range(600)]
    rows += [(5, f"phrase de nombre {i} en francais", "fr") for i in range(600)]
    rows += [(None, "one and the same text", "es")] * 3000 + [(None, f"otra frase {i}", "es") for i in range(40)]
    first, langs = _sample(spark.createDataFrame(rows, SCHEMA).repartition(4))
    second, _ = _sample(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7))
    assert first == second and langs == ["de", "en", "es", "fr"]
    counts = Counter(k for k, _ in first)
    assert counts["de"] == counts["en"] == counts["fr"] >= langid.SAMPLE_DOCS
    texts = {w.split(b"  ")[0] for k, w in first if k == "es"}
    assert len(texts) >= 41  # the repeated text is one of them


def test_seventy_languages(spark):
    words = [f"{chr(97 + k % 26)}{chr(97 + k // 26)}q" for k in range(70)]
    rows = [(i, " ".join([w] * 30), f"l{k:02d}") for i, (k, w) in enumerate((k, w) for k, w in enumerate(words) for _ in range(12))]
    df = spark.createDataFrame(rows, SCHEMA)
    net = langid.fit(df)
    assert len(net.langs) == 70
    least = langid.gate(net, df)
    assert 0 < least <= langid.OVER_EVEN / 70


def test_gate_follows_the_number_of_languages(spark):
    net = langid.Network.fresh(["a", "b", "c"])
    none = spark.createDataFrame([], SCHEMA)
    assert abs(langid.gate(net, none) - 0.4) < 1e-9
    net = langid.Network.fresh(["a"])
    assert langid.gate(net, none) == 1.0


def _naive(net, windows):
    out = np.zeros((len(windows), len(net.langs)))
    for n, window in enumerate(windows):
        hidden = []
        for width, weight, bias in zip(langid.WIDTHS, net.filters, net.bias):
            best = np.full(langid.FILTERS, -np.inf)
            for i in range(len(window) - width + 1):
                patch = np.concatenate([net.embed[b].astype(float) for b in window[i : i + width]])
                best = np.maximum(best, patch @ weight.astype(float) + bias)
            hidden.append(np.maximum(best, 0))
        logits = np.concatenate(hidden) @ net.out.astype(float) + net.out_bias
        out[n] = logits - logits.max() - np.log(np.exp(logits - logits.max()).sum())
    return out


def test_forward_pass_against_plain_loops():
    rng = np.random.default_rng(1)
    net = langid.Network.fresh(["a", "b", "c"])
    for p in net.parameters():
        p += rng.normal(size=p.shape).astype(np.float32) * 0.1
    windows = rng.integers(0, 256, (4, langid.WINDOW), dtype=np.uint8)
    assert np.allclose(net.log_probabilities(windows), _naive(net, windows), atol=1e-3)


def test_gradients_against_differences():
    rng = np.random.default_rng(2)
    net = langid.Network.fresh(["a", "b"])
    windows = rng.integers(97, 123, (6, langid.WINDOW), dtype=np.uint8)
    labels = np.array([0, 1, 0, 1, 1, 0])
    grads = net.gradients(windows, labels)

    def loss():
        return -_naive(net, windows)[np.arange(6), labels].mean()

    for p, g in zip(net.parameters(), grads):
        flat = np.argsort(-np.abs(g).ravel())[:2]
        for k in flat:
            at = np.unravel_index(k, p.shape)
            was, step = p[at], np.float32(1e-2)
            p[at] = was + step
            up = loss()
            p[at] = was - step
            down = loss()
            p[at] = was
            assert abs((up - down) / 2e-2 - g[at]) <= 0.05 * abs(g[at]) + 2e-3


def _all_windows(rows, langs):
    windows, doc = langid.windows_of(langid.texts_of(pa.array([t for _, t, _ in rows])))
    use = langid._LETTER[windows].any(axis=1)
    return windows[use], np.array([langs.index(k) for _, _, k in rows])[doc[use]]


def _long_rows(n):
    rng = np.random.default_rng(3)
    words = ["alpha", "beta", "gamma", "delta", "straße", "été", "niño", "x1", "zz"]
    return [(i, " ".join(rng.choice(words, int(rng.integers(3, 220)))), "abc"[int(rng.integers(0, 20)) % 3]) for i in range(n)]


def test_gate_counts_every_window(spark, monkeypatch):
    """More documents than a sample holds, and windows between those a sample takes."""
    monkeypatch.setattr(langid, "OVER_EVEN", 3.0)
    monkeypatch.setattr(langid, "GATE_SHARE", 0.4)
    rows = _long_rows(3 * langid.SAMPLE_DOCS + 900)
    net = langid.Network.fresh(["a", "b", "c"])
    windows, _ = _all_windows(rows, net.langs)
    scores = np.sort(np.exp(net.log_probabilities(windows).max(axis=1)))
    expected = scores[int(0.4 * len(scores))]
    step = (1 - 1 / 3) / langid.GATE_STEPS
    least = langid.gate(net, spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert expected - step - 1e-6 <= least <= expected + 1e-6


def test_refinement_learns_from_every_window(spark, monkeypatch):
    rows = _long_rows(2500)
    net = langid.Network.fresh(["a", "b", "c"])
    windows, labels = _all_windows(rows, net.langs)
    weights = np.array([0.5, 1.0, 2.0])
    plain = [g.ravel() for g in net.gradients(windows, labels, weights[labels])]
    df = spark.createDataFrame(rows, SCHEMA).select("text", "lang")
    for parts in (2, 5):
        sums = df.repartition(parts).mapInArrow(langid._gradient_batches(net, weights), "place int, value double")
        found = sums.groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").toArrow().column("value")
        assert np.allclose(found.to_numpy(), np.concatenate(plain), rtol=1e-3, atol=1e-2)

    seen = []
    real = langid.Network.gradients
    monkeypatch.setattr(langid.Adam, "take", lambda self, g, rate: seen.append([x.copy() for x in g]))
    langid.refine(net, spark.createDataFrame(rows, SCHEMA))
    assert len(seen) == langid.ROUNDS
    sizes = Counter(k for _, t, k in rows for _ in range(-(-len(t.encode()) // langid.WINDOW)))
    weights = np.array([langid.ROUNDS / (3 * sizes[k]) for k in net.langs])
    whole = real(net, windows, labels, weights[labels])
    for k, g in enumerate(whole):  # each window in one of the rounds
        assert np.allclose(sum(x[k] for x in seen), g, rtol=1e-2, atol=1e-3)
