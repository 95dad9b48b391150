"""Operator 10, benchmark decontamination: rare seeds join passages to items, then Smith-Waterman.

Words are runs of letters and digits (A-Z folded). A passage is aligned with a test
item (match 2, mismatch -1, gap -1); the score over that of a perfect copy is the
leak score, and from ``LEAST_SCORE`` on the item leaks: paraphrased or edited copies
lose some points, chance likeness nearly all.

The search is exact, whatever was edited. A score of half a perfect copy needs half
of the item's ``n`` words matched, h = ceil(n / 2), inside a stretch of at most 2n words. So of any
n - h + k words of the item at least k are matched there. The seeds of an item are
its n - h + k rarest words in the corpus (k = ``HITS``, or h where that is
less); a document is a candidate where k places of seeds lie within 2n words.

1. The benchmark is cut into segments of at most ``SEGMENT`` words of equal length;
   items up to that length are one.
2. The words of the benchmark are counted in the whole corpus (in the tasks first).
3. Seeds meet the documents. A benchmark of at most ``HELD_WORDS`` words, a size
   that is checked, is broadcast, and a task joins its texts with it. A larger one
   is joined by Spark: places of seed words with the seeds on the word, gathered by
   document and segment; then texts of candidates with their segments.
4. Stretches without k places go; so do those that hold too few of the segment's words,
   each counted as often as the segment has it (an upper bound on matches). The
   others are aligned, many at a time, equal passages of a batch once.

In the join two bit filters of a fixed size keep words and texts that can't matter
out; what passes them by chance is sorted out by the join itself. A seed word that a
third of the places hold is one key of an inner join, which Spark splits. Either way
the documents are read the same number of times whatever the benchmark's size.

Defined cases: null text or text without words leaks nothing; items that are
null or have no words are ignored; with no items nothing leaks; rows with null
or repeated ids are judged each by their own text; an empty table gives an
empty result. All other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pickmarts.llm.columns import Scratch
from pickmarts.llm.suffixes import BitFilter
from pickmarts.llm.textwords import NOT_ALNUM, Words, batches_by_bytes, mix64, texts_from_bytes, texts_of, words_of

SEGMENT = 256
HITS = 4
LEAST_SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words of a benchmark that tasks may hold (8 bytes each, and as many again for its seeds).
HELD_WORDS = 1 << 20
#: Words of stretches and passages looked at together, and cells of the alignments made together.
PLACES = 1 << 19
PASSAGES = 1 << 13
CELLS = 1 << 17

_I = np.int64


def _segment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, part, words): the word hashes of each segment."""
    for batch in batches_by_bytes(batches, "text"):
        words = words_of(texts_of(batch.column(1)), lower=True, separators=NOT_ALNUM)
        items, numbers, parts = [], [], []
        for k, item in enumerate(batch.column(0).to_pylist()):
            a, b = words.first[k], words.first[k + 1]
            cuts = np.linspace(a, b, -(-(b - a) // SEGMENT) + 1).astype(_I)
            for part, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])):
                items.append(item)
                numbers.append(part)
                parts.append(words.hash[x:y].view(_I))
        yield pa.RecordBatch.from_arrays(
            [pa.array(items, pa.int64()), pa.array(numbers, pa.int32()), pa.array(parts, pa.list_(pa.int64()))],
            names=["item_id", "part", "words"],
        )


def segments_of(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, part (of its text) and words of every segment; texts given twice under one id count once."""
    usable = benchmark.where(F.col(text).isNotNull() & F.col(item).isNotNull())
    usable = usable.select(F.col(item).cast("long").alias("item_id"), F.col(text).alias("text")).distinct()
    numbered = usable.mapInArrow(_segment_batches, "item_id long, part int, words array<long>")
    # different texts under one id are segments of one item
    return numbered.withColumn("part", F.xxhash64("part", "words"))


def _count_batches(known: BitFilter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_bytes(batches, "text"):
            h = words_of(texts_of(batch.column(0)), lower=True, separators=NOT_ALNUM).hash
            word, n = np.unique(h[known.has(h)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(_I)), pa.array(n)], names=["word", "n"])

    return run


def seeds_of(segments: DataFrame, counts: DataFrame) -> DataFrame:
    """word, item_id, part, size and hits: the rarest words of every segment and how many of them a leak holds at least."""
    words = segments.select("item_id", "part", F.size("words").alias("size"), F.posexplode("words").alias("at", "word"))
    often = counts.select(F.col("word").alias("counted"), "n")
    words = words.join(often, F.col("word") == F.col("counted"), "left")
    segment = Window.partitionBy("item_id", "part").orderBy(F.coalesce("n", F.lit(0)), "word", "at")  # <= SEGMENT rows
    half = F.ceil(F.col("size") / 2)
    words = words.withColumn("hits", F.least(F.lit(HITS), half).cast("int")).withColumn("turn", F.row_number().over(segment))
    rare = words.where(F.col("turn") <= F.col("size") - half + F.col("hits"))
    return rare.select("word", "item_id", "part", "size", "hits").distinct()


def _place_batches(seeds: BitFilter):
    """(doc_id, row, at, word): places of seed words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_bytes(batches, "text"):
            words = words_of(texts_of(batch.column(0)), lower=True, separators=NOT_ALNUM)
            at = np.flatnonzero(seeds.has(words.hash))
            doc = np.searchsorted(words.first, at, side="right") - 1
            owner = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).take(owner),
                    batch.column(2).take(owner),
                    pa.array((at - words.first[doc]).astype(np.int32)),
                    pa.array(words.hash[at].view(_I)),
                ],
                names=["doc_id", "row", "at", "word"],
            )

    return run


def _packed_batches(rows: BitFilter):
    """(packed, doc_id, row) of the texts whose row passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches_by_bytes(batches, "text"):
            use = pa.array(np.flatnonzero(rows.has(batch.column(2).to_numpy().view(np.uint64))))
            texts = texts_of(batch.column(0).take(use))
            packed = pa.array([pack.compress(texts.raw(i)) for i in range(len(texts))], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [packed, batch.column(1).take(use), batch.column(2).take(use)], names=["packed", "doc_id", "row"]
            )

    return run


def align_many(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each pair the best Smith-Waterman score of its word sequences, and the passage position where it ends."""
    n, m = max(len(p) for p in passages), max(len(w) for w in items)
    word, real = np.zeros((len(passages), n), np.uint64), np.zeros((len(passages), n), bool)
    wanted, length = np.zeros((len(items), m), np.uint64), np.array([len(w) for w in items])
    for k, (w, p) in enumerate(zip(items, passages)):
        word[k, : len(p)], real[k, : len(p)], wanted[k, : len(w)] = p, True, w
    ramp = np.arange(1, n + 1, dtype=np.int32) * np.int32(-GAP)
    row = np.zeros((len(passages), n + 1), np.int32)
    best, end, each = np.zeros(len(passages), np.int64), np.zeros(len(passages), np.int64), np.arange(len(passages))
    for j in range(m):
        same = (word == wanted[:, j, None]) & real & (j < length)[:, None]
        new = np.maximum(row[:, :-1] + np.where(same, np.int32(MATCH), np.int32(MISMATCH)), row[:, 1:] + np.int32(GAP))
        np.maximum(new, 0, out=new)
        # gaps along the row: the best earlier cell less its distance
        new += ramp
        np.maximum.accumulate(new, axis=1, out=new)
        new -= ramp
        row[:, 1:] = new
        place = new.argmax(axis=1)
        top = new[each, place]
        better = top > best
        best[better], end[better] = top[better], place[better] + 1
    return best, end


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best Smith-Waterman score of two word sequences, and the passage position where it ends."""
    best, end = align_many([item], [passage])
    return int(best[0]), int(end[0])


class Segments:
    """Segments of items with their words, and how often each word stands in each."""

    def __init__(self, items: list[int], words: list[np.ndarray]):
        self.items, self.words = items, words
        self.size = np.array([len(w) for w in words], _I)
        flat = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.names, self.times = np.unique(self._name(np.repeat(np.arange(len(words)), self.size), flat), return_counts=True)
        bits = min(max(len(self.names) * 16, 1 << 16).bit_length(), 24)
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[(self.names >> self.shift).astype(_I)] = True

    @staticmethod
    def _name(segment: np.ndarray, word: np.ndarray) -> np.ndarray:
        return mix64(word ^ mix64(segment.astype(np.uint64) + np.uint64(1)))

    def most(self, word: np.ndarray, a: np.ndarray, b: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """For each stretch ``word[a:b]`` the most words of its segment in any run of twice the segment's length.

        A word counts as often as the segment has it: an occurrence counts for the
        runs that begin after the last occurrence but so many.
        """
        size = b - a
        first = np.cumsum(size) - size
        own = np.repeat(np.arange(len(a)), size)
        name = self._name(segment[own], word[np.arange(len(own)) + (a - first)[own]])
        at = np.flatnonzero(self.table[(name >> self.shift).astype(_I)])
        k = np.minimum(np.searchsorted(self.names, name[at]), len(self.names) - 1)
        real = self.names[k] == name[at]
        at, times = at[real], self.times[k[real]]
        group = mix64(name[at] + own[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(group, kind="stable")
        at, times, group = at[order], times[order], group[order]
        fresh = np.ones(len(at), bool)
        fresh[1:] = group[1:] != group[:-1]
        begin = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        back = np.arange(len(at)) - times
        low = np.where(back >= begin, at[back] + 1, 0)
        low = np.maximum(low, np.maximum(at - 2 * self.size[segment[own[at]]] + 1, first[own[at]]))
        turns = np.bincount(low, minlength=len(own) + 1) - np.bincount(at + 1, minlength=len(own) + 1)
        return np.maximum.reduceat(np.cumsum(turns), first)


def stretches(
    text: np.ndarray, segment: np.ndarray, at: np.ndarray, size: np.ndarray, hits: np.ndarray
) -> tuple[np.ndarray, ...]:
    """(text, segment, low, high): the stretches that hold every alignment with enough seeds.

    Places ``at`` ascend within (text, segment); ``size`` and ``hits`` are those of the
    segment, for every place. Ends may lie outside the text.
    """
    last = np.arange(len(at)) + hits - 1
    inside = np.minimum(last, len(at) - 1)
    near = (last < len(at)) & (text[inside] == text) & (segment[inside] == segment) & (at[inside] - at < 2 * size)
    i = np.flatnonzero(near)
    text, segment, low, high = text[i], segment[i], at[inside[i]] - 2 * size[i] + 1, at[i] + 2 * size[i]
    fresh = np.ones(len(i), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (segment[1:] != segment[:-1]) | (low[1:] > high[:-1])
    starts = np.flatnonzero(fresh)
    return text[starts], segment[starts], low[starts], high[np.append(starts[1:] - 1, len(i) - 1)] if len(i) else high


def best_places(
    words: Words, segments: Segments, text: np.ndarray, segment: np.ndarray, low: np.ndarray, high: np.ndarray
) -> dict[tuple[int, int], tuple[float, int, int]]:
    """(text, segment) -> score, first and last word of the best alignment in the given stretches, from LEAST_SCORE on."""
    found: dict[tuple[int, int], tuple[float, int, int]] = {}
    if not len(text):
        return found
    a = words.first[text] + np.maximum(low, 0)
    b = np.minimum(words.first[text] + high, words.first[text + 1])
    cuts = np.append(np.flatnonzero(np.diff(np.cumsum(b - a) // PLACES, prepend=-1)), len(a))
    most = [segments.most(words.hash, a[x:y], b[x:y], segment[x:y]) for x, y in zip(cuts[:-1], cuts[1:])]
    able = np.flatnonzero(np.concatenate(most) >= LEAST_SCORE * segments.size[segment])
    for x in range(0, len(able), PASSAGES):
        _align_able(able[x : x + PASSAGES], words, segments, text, segment, a, b, found)
    return found


def _align_able(able, words: Words, segments: Segments, text, segment, a, b, found: dict) -> None:
    same: dict[tuple[int, bytes], int] = {}  # equal passages of a segment are aligned once
    which = [same.setdefault((int(segment[s]), words.hash[a[s] : b[s]].tobytes()), len(same)) for s in able]
    wanted = [segments.words[s] for s, _ in same]
    passages = [np.frombuffer(p, np.uint64) for _, p in same]
    order = sorted(range(len(same)), key=lambda n: (len(wanted[n]), len(passages[n])))
    score, end = np.zeros(len(same), _I), np.zeros(len(same), _I)
    x = 0
    while x < len(order):
        y, wide = x + 1, len(passages[order[x]])
        while y < len(order) and (y - x + 1) * max(wide, len(passages[order[y]])) <= CELLS:
            wide = max(wide, len(passages[order[y]]))
            y += 1
        take = order[x:y]
        score[take], end[take] = align_many([wanted[n] for n in take], [passages[n] for n in take])
        x = y
    for s, n in zip(able, which):
        size, got = len(wanted[n]), score[n] / (MATCH * len(wanted[n]))
        key = (int(text[s]), int(segment[s]))
        if got >= LEAST_SCORE and got > found.get(key, (0.0, 0, 0))[0]:
            last = int(a[s] + end[n] - 1 - words.first[text[s]])
            found[key] = (float(got), max(last - size + 1, 0), last)


_FOUND = ("doc_id", "row", "item_id", "score", "first_word", "last_word")


def _found_rows(ids: pa.Array, rows: pa.Array, segments: Segments, found: dict) -> pa.RecordBatch:
    owner = pa.array([t for t, _ in found], pa.int64())
    score, first, last = zip(*found.values()) if found else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [ids.take(owner), rows.take(owner), pa.array([segments.items[s] for _, s in found], pa.int64())]
        + [pa.array(score, pa.float64()), pa.array(first, pa.int64()), pa.array(last, pa.int64())],
        names=_FOUND,
    )


def _candidate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The leaks among candidates: (packed, doc_id, row, item_id, part, at, hits, words) rows, a text's one after another."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        packed = batch.column(0).to_pylist()
        group = np.cumsum([len(p) for p in packed]) >> 20
        for g in np.unique(group):
            rows = np.flatnonzero(group == g)
            part = batch.slice(rows[0], len(rows))
            own, names = [], {}
            texts: list[int] = []  # first row of each text
            text = np.zeros(len(rows), _I)
            for i, r in enumerate(rows):
                if i == 0 or packed[r] != packed[r - 1] or part.column(1)[i] != part.column(1)[i - 1]:
                    texts.append(i)
                text[i] = len(texts) - 1
                own.append(names.setdefault((part.column(3)[i].as_py(), part.column(4)[i].as_py()), len(names)))
            first = {s: i for i, s in reversed(list(enumerate(own)))}
            segments = Segments(
                [k for k, _ in names], [part.column(7)[first[s]].values.to_numpy().view(np.uint64) for s in range(len(names))]
            )
            words = words_of(
                texts_from_bytes([unpack.decompress(packed[rows[i]]) for i in texts]), lower=True, separators=NOT_ALNUM
            )
            many = np.diff(part.column(5).offsets.to_numpy())
            at = part.column(5).flatten().to_numpy().astype(_I)
            segment = np.array(own, _I)
            hits = part.column(6).to_numpy().astype(_I)
            spread = [np.repeat(x, many) for x in (text, segment)]
            near = stretches(*spread, at, segments.size[spread[1]], np.repeat(hits, many))
            found = best_places(words, segments, *near)
            take = pa.array(texts)
            yield _found_rows(part.column(1).take(take), part.column(2).take(take), segments, found)


@dataclass
class SeedTable:
    """Seeds of all segments sorted by word, small enough for every task to hold."""

    segments: Segments
    hits: np.ndarray  # of a segment
    word: np.ndarray
    segment: np.ndarray

    @classmethod
    def collected(cls, segments: DataFrame, seeds: DataFrame) -> SeedTable:
        """From tables of at most ``HELD_WORDS`` words."""
        rows = sorted(segments.select("item_id", "part", "words").distinct().collect())
        number = {(r["item_id"], r["part"]): i for i, r in enumerate(rows)}
        table = Segments([r["item_id"] for r in rows], [np.array(r["words"], _I).view(np.uint64) for r in rows])
        found = seeds.select("word", "item_id", "part").toArrow()
        parts = zip(found.column("item_id").to_pylist(), found.column("part").to_pylist())
        segment = np.array([number[k] for k in parts], _I)
        word = found.column("word").to_numpy().astype(_I).view(np.uint64)
        order = np.argsort(word, kind="stable")
        return cls(table, np.minimum(HITS, -(-table.size // 2)), word[order], segment[order])

    def places(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, segment, place) of every seed word in the texts, sorted."""
        known = np.unique(self.word)
        k = np.minimum(np.searchsorted(known, words.hash), max(len(known) - 1, 0)) if len(known) else np.zeros(0, _I)
        at = np.flatnonzero(known[k] == words.hash) if len(known) else k
        low = np.searchsorted(self.word, words.hash[at], side="left")
        many = np.searchsorted(self.word, words.hash[at], side="right") - low
        use = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
        at = np.repeat(at, many)
        text, segment = np.searchsorted(words.first, at, side="right") - 1, self.segment[use]
        order = np.argsort(text * len(self.segments.size) + segment, kind="stable")  # places ascend already
        return text[order], segment[order], (at - words.first[text])[order]


def _held_batches(table):
    """The leaks of whole texts, (text, doc_id, row) rows, with the seeds held in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: SeedTable = table.value
        for batch in batches_by_bytes(batches, "text", 1 << 20):
            words = words_of(texts_of(batch.column(0)), lower=True, separators=NOT_ALNUM)
            text, segment, at = seeds.places(words)
            near = stretches(text, segment, at, seeds.segments.size[segment], seeds.hits[segment])
            found = best_places(words, seeds.segments, *near)
            yield _found_rows(batch.column(1), batch.column(2), seeds.segments, found)

    return run


def _row_name(key: str, text: str) -> Column:
    return F.xxhash64(key, text)


def _leaked_rows(df: DataFrame, benchmark: DataFrame, key: str, text: str, held_words: int) -> DataFrame:
    """(doc_id, row, item_id, score, first_word, last_word) for every different row, ``row`` being its hash."""
    scratch = Scratch(df.sparkSession, "leaks")
    docs = df.where(F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(key).alias("doc_id"), _row_name(key, text).alias("row")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    segments = scratch.keep(segments_of(benchmark), "segments")
    vocabulary = BitFilter(segments.select(F.explode("words").alias("word")).distinct(), "word")
    counts = docs.select("text").mapInArrow(_count_batches(vocabulary), "word long, n long")
    counts = scratch.keep(counts.groupBy("word").agg(F.sum("n").alias("n")), "counts")
    seeds = scratch.keep(seeds_of(segments, counts), "seeds")

    schema = f"doc_id {kind}, row long, item_id long, score double, first_word long, last_word long"
    if (segments.agg(F.sum(F.size("words"))).first()[0] or 0) <= held_words:
        table = df.sparkSession.sparkContext.broadcast(SeedTable.collected(segments, seeds))
        found = docs.mapInArrow(_held_batches(table), schema)
    else:
        found = _joined(docs, kind, segments, seeds, scratch).mapInArrow(_candidate_batches, schema)
    # of an item's segments the best, then the earliest; equal rows are one
    place = F.struct("score", -F.col("first_word"), F.col("first_word"), F.col("last_word"))
    best = found.groupBy("doc_id", "row", "item_id").agg(F.max(place).alias("b"))
    best = best.select("doc_id", "row", "item_id", F.col("b.score"), F.col("b.first_word"), F.col("b.last_word"))
    best = scratch.keep(best, "leaked")
    scratch.drop("segments", "counts", "seeds", "candidates")
    return best


def _joined(docs: DataFrame, kind: str, segments: DataFrame, seeds: DataFrame, scratch: Scratch) -> DataFrame:
    """Candidates with their texts and segments, by joins on the words."""
    places = docs.mapInArrow(
        _place_batches(BitFilter(seeds.select("word").distinct(), "word")), f"doc_id {kind}, row long, at int, word long"
    )
    met = places.join(seeds.select(F.col("word").alias("seed"), "item_id", "part", "size", "hits"), F.col("word") == F.col("seed"))
    met = met.groupBy("doc_id", "row", "item_id", "part", "size", "hits").agg(F.sort_array(F.collect_set("at")).alias("at"))
    close = "exists(sequence(1, size(at) - hits + 1), i -> element_at(at, i + hits - 1) - element_at(at, i) < 2 * size)"
    candidates = scratch.keep(met.where(F.expr(f"if(size(at) >= hits, {close}, false)")), "candidates")

    texts = docs.mapInArrow(_packed_batches(BitFilter(candidates, "row")), f"packed binary, doc_id {kind}, row long")
    texts = texts.dropDuplicates(["doc_id", "row"]).select("packed", F.col("doc_id").alias("d2"), F.col("row").alias("r2"))
    wanted = segments.select(F.col("item_id").alias("i2"), F.col("part").alias("p2"), "words").distinct()
    same = (F.col("row") == F.col("r2")) & F.col("doc_id").eqNullSafe(F.col("d2"))
    pairs = candidates.join(wanted, (F.col("item_id") == F.col("i2")) & (F.col("part") == F.col("p2"))).join(texts, same)
    return pairs.select("packed", "doc_id", "row", "item_id", "part", "at", "hits", "words").sortWithinPartitions("row", "doc_id")


def _same_row(df: DataFrame, key: str, text: str, found: DataFrame) -> tuple[DataFrame, Column]:
    """``found`` under fresh names, and the condition that a row of ``df`` is one of its rows."""
    names = {c: f"{c}_{len(max(df.columns, key=len))}" for c in ("doc_id", "row")}  # longer than any column of df
    found = found.withColumnsRenamed(names)
    same = (_row_name(key, text) == F.col(names["row"])) & F.col(key).eqNullSafe(F.col(names["doc_id"]))
    return found, same


def leaks(
    df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", held_words: int = HELD_WORDS
) -> DataFrame:
    """One row per document and leaked item: key, item_id, score (0.5 to 1), first_word and last_word of the passage."""
    found, same = _same_row(df.select(key, text), key, text, _leaked_rows(df, benchmark, key, text, held_words))
    out = df.select(key, text).where(F.col(text).isNotNull()).join(found, same)
    return out.select(key, "item_id", "score", "first_word", "last_word")


def decontaminated(
    df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", held_words: int = HELD_WORDS
) -> DataFrame:
    """The rows of ``df`` into which no benchmark item leaks, columns unchanged."""
    found = _leaked_rows(df, benchmark, key, text, held_words).select("doc_id", "row").distinct()
    found, same = _same_row(df, key, text, found)
    return df.join(found, same, "left_anti")
