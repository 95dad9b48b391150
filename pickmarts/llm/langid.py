"""Operator 5, language ID by a byte convolutional network.

The network reads a window of ``WINDOW`` bytes: byte embeddings, convolutions of
widths 2 to 4 with rectified outputs, the maximum of every filter over the
window, and a softmax over the languages. It is trained in numpy (Adam) on a
bounded sample of labelled text (``fit``). ``refine`` then learns from every window
of every labelled row: the rows are dealt to ``ROUNDS`` rounds by a hash, the tasks
sum the gradient of a round over all its windows, and the driver takes one step
a round from that sum, so the weights don't depend on the layout of the table but
for rounding. The pipeline refines its network and takes its gate from all windows of the held-out
rows; the query ``op5_language_id`` uses the network of the sample.

A text is scored over all its windows, end to
end and in batches of windows; a document's probabilities are the softmax of
its windows' mean log-probabilities, weighted by the letters they hold.

Sample bound (documented parameters): ``SAMPLE_DOCS`` documents per language,
chosen by a hash of their id, and up to ``SAMPLE_WINDOWS`` windows spread over
the whole of each text. Languages come from a count over all labelled rows. A window is the same number of bytes
for any text, so memory follows the batch.

Defined cases: null text, or text without any letter, is ``und`` with score 0;
with no labelled text at all every document is ``und``; lang, source and doc_id
are never inputs of a prediction; repeated rows get equal predictions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pickmarts.llm.columns import crc_remainder, drop_named, fresh_prefix
from pickmarts.llm.textwords import Texts, batches_by_bytes, texts_of

WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 24
EMBEDDING = 8
SAMPLE_DOCS = 500
SAMPLE_WINDOWS = 4
EPOCHS = 5
BATCH = 128
RATE = 4e-3
# steps over all rows after those over the sample, and their first rate
ROUNDS = 6
REFINE_RATE = 5e-4
UND = "und"


@dataclass
class Network:
    """Weights of the network; ``langs`` in the order of the outputs."""

    langs: list[str]
    embed: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # per width: width * EMBEDDING x FILTERS
    bias: list[np.ndarray]
    out: np.ndarray  # len(WIDTHS) * FILTERS x languages
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, langs: list[str], seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)

        def draw(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return cls(
            langs,
            draw(256, EMBEDDING, scale=0.5),
            [draw(w * EMBEDDING, FILTERS, scale=(2 / (w * EMBEDDING)) ** 0.5) for w in WIDTHS],
            [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            draw(len(WIDTHS) * FILTERS, len(langs), scale=0.1),
            np.zeros(len(langs), np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, *self.bias, self.out, self.out_bias]

    def taps(self) -> list[list[np.ndarray]]:
        """A tap's contribution depends on one byte only: embedding times filter slice, as a table of 256 rows."""
        shaped = [f.reshape(w, EMBEDDING, FILTERS) for w, f in zip(WIDTHS, self.filters)]
        return [[self.embed @ tap for tap in taps] for taps in shaped]

    def log_probabilities(self, windows: np.ndarray, taps: list[list[np.ndarray]] | None = None) -> np.ndarray:
        """windows (n x WINDOW bytes) -> n x languages; one gather per filter tap, no matrix of patches."""
        pooled = []
        for width, tables, bias in zip(WIDTHS, taps or self.taps(), self.bias):
            span = windows.shape[1] - width + 1
            total = tables[0][windows[:, :span]]
            for k in range(1, width):
                total += tables[k][windows[:, k : k + span]]
            pooled.append(np.maximum(total.max(axis=1) + bias, 0))
        logits = np.concatenate(pooled, axis=1) @ self.out + self.out_bias
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def gradients(self, windows: np.ndarray, labels: np.ndarray, shares: np.ndarray | None = None) -> list[np.ndarray]:
        """Of the mean cross entropy, or of its sum with a share for each window."""
        n = len(windows)
        x = self.embed[windows]
        pooled, best, patches = [], [], []
        for width, weight, bias in zip(WIDTHS, self.filters, self.bias):
            span = windows.shape[1] - width + 1
            cols = np.concatenate([x[:, k : k + span] for k in range(width)], axis=2)
            act = cols @ weight + bias
            at = act.argmax(axis=1)
            pooled.append(np.take_along_axis(act, at[:, None], axis=1)[:, 0])
            best.append(at)
            patches.append(cols)
        hidden = np.concatenate(pooled, axis=1)
        live = np.maximum(hidden, 0)
        logits = live @ self.out + self.out_bias
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(n), labels] -= 1
        p = p / np.float32(n) if shares is None else p * shares[:, None].astype(np.float32)
        g_out, g_bias = live.T @ p, p.sum(axis=0)
        g_hidden = (p @ self.out.T) * (hidden > 0)
        g_embed = np.zeros_like(self.embed)
        g_filters, g_filter_bias = [], []
        for i, (width, weight) in enumerate(zip(WIDTHS, self.filters)):
            g = g_hidden[:, i * FILTERS : (i + 1) * FILTERS]
            rows = np.arange(n)[:, None]
            chosen = patches[i][rows, best[i]]  # n x FILTERS x patch: the winning patch of every filter
            g_filters.append(np.einsum("nfp,nf->pf", chosen, g))
            g_filter_bias.append(g.sum(axis=0))
            back = g[:, :, None] * weight.T[None]
            for k in range(width):
                byte = windows[rows, best[i] + k]
                np.add.at(g_embed, byte.ravel(), back[:, :, k * EMBEDDING : (k + 1) * EMBEDDING].reshape(-1, EMBEDDING))
        return [g_embed, *g_filters, *g_filter_bias, g_out, g_bias]


class Adam:
    """Steps on the parameters of a network, in place."""

    def __init__(self, params: list[np.ndarray]):
        self.params = params
        self.m = [np.zeros_like(p) for p in params]
        self.v = [np.zeros_like(p) for p in params]
        self.step = 0

    def take(self, gradients: list[np.ndarray], rate: float) -> None:
        self.step += 1
        for p, g, a, b in zip(self.params, gradients, self.m, self.v):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= rate * (a / (1 - 0.9**self.step)) / (np.sqrt(b / (1 - 0.999**self.step)) + 1e-8)


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], seed: int = 7) -> Network:
    """Adam on cross entropy; languages weigh alike through their equal samples."""
    net = Network.fresh(langs, seed)
    adam = Adam(net.parameters())
    rng = np.random.default_rng(seed)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            take = order[at : at + BATCH]
            adam.take(net.gradients(windows[take], labels[take]), RATE * (0.7**epoch))
    return net


def windows_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """All windows of every text end to end (the last padded with spaces), and the text of each."""
    sizes = np.diff(texts.offsets)
    each = -(-sizes // WINDOW)
    doc = np.repeat(np.arange(len(texts)), each)
    begin = (np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)) * WINDOW
    at = (texts.offsets[:-1][doc] + begin)[:, None] + np.arange(WINDOW)
    inside = at < texts.offsets[1:][doc][:, None]
    data = np.append(texts.data, np.uint8(32))
    return np.where(inside, data[np.where(inside, at, 0)], np.uint8(32)).astype(np.uint8), doc


_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _predict_batches(net: Network, text: str, returned: list[str], out: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, taps = np.array(net.langs, dtype=object), net.taps()
        for batch in batches_by_bytes(batches, text, most=1 << 20):
            texts = texts_of(batch.column(batch.schema.get_field_index(text)))
            total = np.zeros((len(texts), len(net.langs)))
            weight = np.zeros(len(texts))
            windows, doc = windows_of(texts)
            for at in range(0, len(windows), 256):
                part = windows[at : at + 256]
                letters = _LETTER[part].sum(axis=1) + 1e-3
                np.add.at(total, doc[at : at + 256], net.log_probabilities(part, taps) * letters[:, None])
                np.add.at(weight, doc[at : at + 256], letters)
            mean = total / np.maximum(weight, 1e-3)[:, None]
            mean -= mean.max(axis=1, keepdims=True)
            p = np.exp(mean)
            p /= p.sum(axis=1, keepdims=True)
            best = p.argmax(axis=1)
            kept = batch.select(returned)
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(names[best], pa.string()), pa.array(p[np.arange(len(p)), best])],
                names=[*returned, *out],
            )

    return run


def sample_windows(labelled: DataFrame, text: str, lang: str, key: Column) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Training windows, label numbers and languages, from a bounded sample of ``labelled``.

    SAMPLE_DOCS different texts of every language, those with the smallest hash of
    (key, text): a function of the table, whatever its order, however many rows
    share a key and however often a text stands. At most SAMPLE_DOCS *
    SAMPLE_WINDOWS windows of a language reach the driver.
    """
    body = F.col(text).cast("binary")
    spread = F.transform(
        F.sequence(F.lit(0), F.lit(SAMPLE_WINDOWS - 1)),
        lambda k: F.substring(
            body, (F.floor(F.octet_length(body) * k / SAMPLE_WINDOWS)).cast("int") + 1, F.lit(WINDOW)
        ),
    )
    rows = labelled.select(F.col(lang).alias("lang"), F.xxhash64(key, F.col(text)).alias("at"), F.array_distinct(spread).alias("w"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("at").alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64), []
    # rows that can't be among the first are left out before anything moves: twice as many as wanted stay
    chance = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, 2 * SAMPLE_DOCS / max(counts[k], 1))))])
    draw = F.pmod("at", F.lit(1 << 40))
    rows = rows.where(draw / float(1 << 40) <= F.element_at(chance, F.col("lang")))
    rows = rows.groupBy("lang", "at").agg(F.first("w").alias("w"))
    first = Window.partitionBy("lang").orderBy(draw, "at")
    rows = rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= SAMPLE_DOCS).collect()
    rows.sort(key=lambda r: (r["at"], r["lang"], r["w"]))
    number = {k: i for i, k in enumerate(langs)}
    pieces = [(bytes(w), number[r["lang"]]) for r in rows for w in r["w"] if any(_LETTER[b] for b in bytes(w))]
    windows = np.full((len(pieces), WINDOW), 32, np.uint8)
    for i, (w, _) in enumerate(pieces):
        windows[i, : len(w)] = np.frombuffer(w, np.uint8)
    return windows, np.array([k for _, k in pieces], np.int64), langs


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Network | None:
    """A network trained on the labelled rows (null text or label ignored); None if there are none."""
    usable = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    windows, labels, langs = sample_windows(usable, text, lang, F.col(key))
    return train(windows, labels, langs) if len(windows) else None


def _gradient_batches(net: Network, weights: np.ndarray):
    """(place, value): the gradient over all windows of a task's rows (text, lang), a row for every weight of the network."""
    number = {k: i for i, k in enumerate(net.langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(sum(p.size for p in net.parameters()))
        for batch in batches_by_bytes(batches, "text", most=1 << 18):
            label = np.array([number.get(k, -1) for k in batch.column(1).to_pylist()])
            windows, doc = windows_of(texts_of(batch.column(0)))
            use = np.flatnonzero(_LETTER[windows].any(axis=1) & (label[doc] >= 0))
            for at in range(0, len(use), BATCH):
                part = use[at : at + BATCH]
                own = label[doc[part]]
                total += np.concatenate([g.ravel() for g in net.gradients(windows[part], own, weights[own])])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["place", "value"]
        )

    return run


def refine(net: Network, labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Network:
    """``net`` after ``ROUNDS`` steps over all windows of the labelled rows, each row in one of them.

    Languages weigh alike, by their windows in the whole table. Only sums reach the
    driver: a number for every language and, a round, one for every weight of the network.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(ROUNDS)).alias("round")
    )
    windows = F.sum(F.ceil(F.octet_length("text") / WINDOW))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(windows.alias("n")).collect()}
    weights = np.array([ROUNDS / (len(net.langs) * max(counts.get(k, 0), 1)) for k in net.langs])
    adam = Adam(net.parameters())
    for k in range(ROUNDS):
        part = rows.where(F.col("round") == k).select("text", "lang")
        sums = part.mapInArrow(_gradient_batches(net, weights), "place int, value double")
        sums = sums.groupBy("place").agg(F.sum("value").alias("value")).toArrow()
        flat = np.zeros(sum(p.size for p in adam.params))
        flat[sums.column("place").to_numpy()] = sums.column("value").to_numpy()
        cuts = np.split(flat, np.cumsum([p.size for p in adam.params])[:-1])
        adam.take([g.reshape(p.shape).astype(np.float32) for g, p in zip(cuts, adam.params)], REFINE_RATE * (0.7**k))
    return net


def identify(df: DataFrame, net: Network | None, text: str = "text", returned: list[str] | None = None) -> DataFrame:
    """All rows of ``df`` with lang_pred and score after the ``returned`` columns (all of them by default)."""
    df = drop_named(df, "lang_pred", "score")
    returned = returned if returned is not None else df.columns
    prefix = fresh_prefix(df)
    letter, best, sure = f"{prefix}letter", f"{prefix}lang", f"{prefix}score"
    rows = df.withColumn(letter, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    shown = [F.col(f"`{c}`") for c in returned]
    if net is None:
        return rows.select(*shown, F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))
    kept = [*returned, letter]
    schema = StructType([rows.schema[c] for c in kept]).add(best, "string").add(sure, "double")
    out = rows.mapInArrow(_predict_batches(net, text, kept, [best, sure]), schema)
    return out.select(
        *shown,
        F.when(F.col(letter), F.col(best)).otherwise(UND).alias("lang_pred"),
        F.when(F.col(letter), F.col(sure)).otherwise(0.0).alias("score"),
    )


def training_rows(df: DataFrame) -> DataFrame:
    """The documents one may learn from: crc32(doc_id as text) mod 3 is not 1."""
    return df.where(crc_remainder(F.col("doc_id"), 3) != 1)


def op5_identify(df: DataFrame) -> DataFrame:
    """The contract's columns for a documents table."""
    net = fit(training_rows(df))
    out = identify(df.select("doc_id", "text"), net, returned=["doc_id"])
    return out.select("doc_id", (crc_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


# The share of held-out windows whose score lies below the gate, the gate's most over an even guess, and its steps between.
GATE_SHARE = 0.001
OVER_EVEN = 1.2
GATE_STEPS = 4096


def _step_counts(net: Network, most: float):
    """(step, n): how many windows of a task's texts score in each step from an even guess to ``most`` (GATE_STEPS: above)."""
    even = 1 / len(net.langs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, taps = np.zeros(GATE_STEPS + 1, np.int64), net.taps()
        for batch in batches_by_bytes(batches, "text", most=1 << 18):
            windows, _ = windows_of(texts_of(batch.column(0)))
            windows = windows[_LETTER[windows].any(axis=1)]
            for at in range(0, len(windows), 256):
                score = np.exp(net.log_probabilities(windows[at : at + 256], taps).max(axis=1).astype(float))
                step = np.floor((score - even) / (most - even) * GATE_STEPS).astype(np.int64)
                counts += np.bincount(np.clip(step, 0, GATE_STEPS), minlength=GATE_STEPS + 1)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(counts[seen])], names=["step", "n"])

    return run


def gate(net: Network, heldout: DataFrame, text: str = "text", lang: str = "lang") -> float:
    """The least score of a document whose language is recognised.

    The score that all but ``GATE_SHARE`` of all windows of the held-out labelled
    documents reach, to one of ``GATE_STEPS`` steps, but at most ``OVER_EVEN`` times an
    even guess among the learned languages. Without held-out rows the latter. At
    most GATE_STEPS + 1 counts reach the driver.
    """
    even = 1 / len(net.langs)
    most = min(OVER_EVEN * even, 1.0)
    if most <= even:
        return most
    usable = heldout.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"))
    found = usable.mapInArrow(_step_counts(net, most), "step int, n long").groupBy("step").agg(F.sum("n").alias("n"))
    counts = np.zeros(GATE_STEPS + 1, np.int64)
    for r in found.collect():
        counts[r["step"]] = r["n"]
    below = np.cumsum(counts[:-1])  # windows below the end of each step
    steps = int((below <= GATE_SHARE * counts.sum()).sum())
    return even + (most - even) * steps / GATE_STEPS


def known_language(df: DataFrame) -> DataFrame:
    """The documents whose language is recognised, columns unchanged; all go where there is nothing to learn from."""
    net = fit(training_rows(df))
    if net is None:
        return df.where("false")
    net = refine(net, training_rows(df))
    least = gate(net, df.where(crc_remainder(F.col("doc_id"), 3) == 1))
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole")
    out = identify(df.select(whole, "text"), net, returned=["whole"])
    return out.where((F.col("lang_pred") != UND) & (F.col("score") >= least)).select(
        *[F.col(f"whole.`{c}`").alias(c) for c in df.columns]
    )
