"""Operator 2, substring dedup with compressed FM-indexes.

A window is ``WINDOW`` consecutive words. A word is removed if a window over it
also starts in a document with a smaller id. All windows are judged on the input.

1. Sharding by content. Of the four-word runs inside a window the one with the
   smallest hash is its anchor, so equal windows have equal anchors wherever they
   stand. Consecutive windows with the same anchor form a passage (at most
   ``WINDOW - GRAMS[0] + 1`` windows). Anchors of one document only cannot hold a
   shared window; the others are found by an aggregation (counted map-side), and
   only their passages go on.
2. Equal passages become one, with the smallest document id that holds it, so a
   passage in a third of all documents is one row. Passages are dealt to shards by
   their anchor: a window occurs in one shard only.
3. A shard builds an FM-index over its passages: suffix array, Burrows-Wheeler
   transform, and a wavelet matrix of packed bits with block counts for rank
   queries. Its passages are streamed through it by backward search, all windows
   of the shard in step. A window's matching statistic is the number of its last
   words that occur elsewhere in the shard too; where it reaches ``WINDOW``, the
   interval of suffixes is reported with the smallest document id in it.
4. Reported windows meet the occurrences of their passage by a join, and the words
   they cover are cut from the texts.

Shards hold about ``SHARD_WORDS`` words: their number follows the data. An anchor
with more than ``HOT_PASSAGES`` different passages would overflow its shard: its
passages are cut anew by the next longer anchor of ``GRAMS``, equal pieces become
one row, and the pieces are dealt and searched like all passages. An anchor as long as a
window has one piece, so none is left over. Passages are named by anchor and
content (128 bits).

Defined cases: null or blank text has no words (kept_sha256 of no bytes); texts
of fewer words than a window lose nothing; rows with a null id neither lose words
nor make others lose any; rows with equal ids never cut one another; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickmarts.llm.columns import Scratch
from pickmarts.llm.textwords import (
    Words,
    batches_by_bytes,
    distinct_per_text,
    mix64,
    texts_from_bytes,
    texts_of,
    words_of,
)

WINDOW = 13
# words of an anchor: usually, and of hot ones
GRAMS = (4, 8, WINDOW)
SHARD_WORDS = 1 << 15
WORD_BYTES = 6  # of a usual word and its space, to count shards
HOT_PASSAGES = 4096

_U = np.uint64
_I = np.int64


def _anchors(words: Words, size: int = GRAMS[0]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every window's text and first word, and the word position and hash of its anchor."""
    counts = np.maximum(words.counts() - WINDOW + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(words.first[:-1], counts)
    n = len(words.hash)
    if not len(start):
        return doc, start, start, np.zeros(0, np.uint64)

    gram = np.zeros(n, np.uint64)
    for k in range(size):
        gram[: n - k] = gram[: n - k] * _U(0x2545F4914F6CDD1D) + words.hash[k:]
        gram ^= gram >> _U(29)
    gram = mix64(gram)
    # position of the first smallest gram in every stretch, by doubling the stretch
    span, reach = WINDOW - size + 1, 1
    best = np.arange(n)
    while reach < span:
        step = min(reach, span - reach)
        other = best[step:]
        head = best[: n - step]
        best[: n - step] = np.where(gram[head] <= gram[other], head, other)
        reach += step
    at = best[start]
    return doc, start, at, gram[at]


def _runs(doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of every run with one anchor position."""
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(fresh)
    return first, np.diff(np.append(first, len(at)))


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_by_bytes(batches, "text"):
        doc, _, at, gram = _anchors(words_of(texts_of(batch.column(1)), lower=False))
        first, _ = _runs(doc, at)
        anchor, owner = distinct_per_text(gram[first], doc[first], batch.num_rows)
        ids = batch.column(0).to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor.view(_I)), pa.array(ids[owner])], names=["anchor", "doc_id"]
        )


def _pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches_by_bytes(batches, "text"):
        texts = texts_of(batch.column(0))
        packed = pa.array([pack.compress(texts.raw(i)) for i in range(len(texts))], pa.binary())
        yield pa.RecordBatch.from_arrays([packed, *batch.columns[1:]], names=["packed", *batch.schema.names[1:]])


def _unpacked(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of about ``most`` packed bytes with their texts."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        packed = batch.column(0).to_pylist()
        group = np.cumsum([len(p) for p in packed]) // most
        for g in np.unique(group):
            rows = np.flatnonzero(group == g)
            part = batch.slice(rows[0], len(rows))
            yield part, [unpack.decompress(packed[i]) for i in rows]


def _passages(words: Words, data: bytes, start: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Name and content of the passages of ``windows`` windows from the words ``start`` on."""
    names = np.zeros(len(start), np.uint64)
    for n in np.unique(windows):
        same = windows == n
        content = words.hash[start[same][:, None] + np.arange(n + WINDOW - 1)]
        name = np.full(len(content), _U(n))
        for c in range(content.shape[1]):
            name = mix64(name + content[:, c])
        names[same] = name
    spans = zip(words.start[start].tolist(), words.end[start + windows + WINDOW - 2].tolist())
    return names, [b" ".join(data[x:y].split()) for x, y in spans]


def _passage_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, doc_id, start, anchor, passage, content): the passages whose anchor is shared.

    ``start`` is the passage's first word in its text, ``passage`` names its content.
    """
    for batch, raw in _unpacked(batches):
        words = words_of(texts_from_bytes(raw), lower=False)
        doc, start, at, gram = _anchors(words)
        first, windows = _runs(doc, at)
        lists = batch.column(3)
        shared = lists.values.to_numpy().view(np.uint64) if len(lists.values) else np.zeros(0, np.uint64)
        # a run goes on if its anchor is in its own text's list
        borders = lists.offsets.to_numpy()
        owner = np.repeat(np.arange(len(lists)), np.diff(borders))
        shared = shared[borders[0] : borders[-1]]
        want = np.unique(mix64(shared) + owner.astype(np.uint64))
        have = mix64(gram[first]) + doc[first].astype(np.uint64)
        k = np.minimum(np.searchsorted(want, have), max(len(want) - 1, 0))
        use = want[k] == have if len(want) else np.zeros(len(have), bool)
        first, windows = first[use], windows[use]
        rows, ids = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        names, contents = _passages(words, b"".join(raw), start[first], windows)
        d = doc[first]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows[d]),
                pa.array(ids[d]),
                pa.array((start[first] - words.first[d]).astype(np.int32)),
                pa.array(gram[first].view(_I)),
                pa.array(names.view(_I)),
                pa.array(contents, pa.binary()),
            ],
            names=["row", "doc_id", "start", "anchor", "passage", "content"],
        )


class WaveletMatrix:
    """Rank queries on a sequence of symbols: one packed bit vector per symbol bit."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = max(int(symbols - 1).bit_length(), 1)
        self.bits, self.before, self.zeros = [], [], []
        n = len(sequence)
        for level in range(self.levels - 1, -1, -1):
            bit = (sequence >> level) & 1
            padded = np.zeros(-(-(n + 1) // 64) * 64, np.uint8)
            padded[:n] = bit
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            self.bits.append(packed)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed))]).astype(np.int32))
            self.zeros.append(n - int(bit.sum()))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        block = i >> 6
        rest = self.bits[level][block] & ((_U(1) << (i & 63).astype(np.uint64)) - _U(1))
        return self.before[level][block] + np.bitwise_count(rest)

    def rank(self, symbol: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol before positions i and j, both offset by the symbol's own start."""
        for level in range(self.levels):
            up = (symbol >> (self.levels - 1 - level)) & 1 == 1
            a, b = self._ones(level, i), self._ones(level, j)
            i = np.where(up, self.zeros[level] + a, i - a)
            j = np.where(up, self.zeros[level] + b, j - b)
        return i, j


class FMIndex:
    """Backward search over a sequence of small integers."""

    def __init__(self, text: np.ndarray):
        self.suffixes = self._suffix_array(text)
        symbols = int(text.max()) + 1 if len(text) else 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.wavelet = WaveletMatrix(text[self.suffixes - 1], symbols)
        # where the rank of a symbol starts to count: its rank at position 0
        every = np.arange(symbols)
        self.base, _ = self.wavelet.rank(every, np.zeros(symbols, _I), np.zeros(symbols, _I))

    @staticmethod
    def _suffix_array(text: np.ndarray) -> np.ndarray:
        """Order of the rotations of ``text`` by prefix doubling."""
        n = len(text)
        if n == 0:
            return np.zeros(0, _I)
        # as many symbols as fit a number make the first key, then each round doubles the prefix
        bits = int(text.max()).bit_length() + 1
        reach = max(60 // bits, 1)
        key = np.zeros(n, _I)
        for k in range(reach):
            key = key << bits | np.roll(text, -k)
        while True:
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            place = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            if place[-1] == n - 1 or reach >= n:
                return order
            rank = np.empty(n, _I)
            rank[order] = place
            key = rank * (n + 1) + np.roll(rank, -reach)
            reach *= 2

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistic and suffix interval [lo, hi) of every pattern, a row of words of the text itself.

        The statistic is the number of the pattern's last words that more than one
        suffix begins with. Backward search stops beyond it: the interval then holds
        the one suffix of the tail that is a word longer.
        """
        m = len(patterns)
        lo, hi = np.zeros(m, _I), np.full(m, len(self.suffixes), _I)
        statistic = np.zeros(m, _I)
        live = np.arange(m)
        for k in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[live, k]
            a, b = self.wavelet.rank(c, lo[live], hi[live])
            lo[live], hi[live] = self.first[c] + a - self.base[c], self.first[c] + b - self.base[c]
            live = live[hi[live] - lo[live] > 1]
            if not len(live):
                break
            statistic[live] += 1
        return statistic, lo, hi


def window_minima(passages: list[np.ndarray], least: np.ndarray) -> list[np.ndarray]:
    """For every window of every passage the smallest ``least`` of all passages that hold the window.

    Passages are arrays of word hashes, all in one shard.
    """
    lengths = np.array([len(p) for p in passages])
    _, ranks = np.unique(np.concatenate(passages), return_inverse=True)
    # the passages one after the other, each closed by its own smallest symbol 0
    place = np.arange(len(ranks)) + np.repeat(np.arange(len(passages)), lengths)
    text = np.zeros(len(ranks) + len(passages), _I)
    text[place] = ranks + 1
    owner = np.repeat(np.arange(len(passages)), lengths + 1)
    index = FMIndex(text)
    begin = np.cumsum(lengths + 1) - lengths - 1
    windows = lengths - WINDOW + 1
    start = np.repeat(begin, windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    # equal windows are searched once
    name = np.zeros(len(start), np.uint64)
    for k in range(WINDOW):
        name = mix64(name + text[start + k].astype(np.uint64))
    _, one, where = np.unique(name, return_index=True, return_inverse=True)
    statistic, lo, hi = index.search(text[start[one][:, None] + np.arange(WINDOW)])
    # below the threshold a window stands only where it is; the intervals above are disjoint, with one minimum for each
    found = least[owner[start[one]]]
    several = np.flatnonzero(statistic >= WINDOW)
    if len(several):
        order = several[np.argsort(lo[several])]
        by_suffix = np.append(least[owner[index.suffixes]], np.iinfo(_I).max)
        edges = np.stack([lo[order], hi[order]], axis=1).ravel()
        found[order] = np.minimum.reduceat(by_suffix, edges)[::2]
    return np.split(found[where], np.cumsum(windows)[:-1])


def _search_shard(shard: pa.Table) -> pa.Table:
    """(anchor, passage, minima) of one shard."""
    words = words_of(texts_from_bytes(shard.column("content").to_pylist()), lower=False)
    minima = window_minima(np.split(words.hash, words.first[1:-1]), shard.column("least").to_numpy())
    return pa.table(
        {"anchor": shard.column("anchor"), "passage": shard.column("passage"), "minima": pa.array(minima, pa.list_(pa.int64()))}
    )


def _recut_batches(size: int):
    """Cut passages (anchor, passage, content, least) into pieces whose windows share an anchor of ``size`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = batch.column(2).to_pylist()
            words = words_of(texts_from_bytes(raw), lower=False)
            doc, start, at, gram = _anchors(words, size)
            first, windows = _runs(doc, at)
            names, contents = _passages(words, b"".join(raw), start[first], windows)
            d = doc[first]
            whole = pa.array(d)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(whole),
                    batch.column(1).take(whole),
                    pa.array((start[first] - words.first[d]).astype(np.int32)),
                    pa.array(gram[first].view(_I)),
                    pa.array(names.view(_I)),
                    pa.array(contents, pa.binary()),
                    batch.column(3).take(whole),
                ],
                names=["whole_anchor", "whole", "window", "anchor", "passage", "content", "least"],
            )

    return run


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_words, n_removed, kept): texts without the words their cut windows cover."""
    for batch, raw in _unpacked(batches):
        counts, removed, kept = [], [], []
        for text, starts in zip(raw, batch.column(2).to_pylist()):
            words = text.split()
            counts.append(len(words))
            if starts:
                edge = np.zeros(len(words) + 1, np.int32)
                s = np.unique(np.array(starts))
                edge[s] += 1
                np.add.at(edge, s + WINDOW, -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed.append(int(gone.sum()))
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            else:
                removed.append(0)
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _cut_batches(batches):
        digests = [hashlib.sha256(k).hexdigest() for k in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(digests)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _reported(distinct: DataFrame, tables: Scratch) -> DataFrame:
    """(anchor, passage, minima) of all passages of the kept table "distinct-0" (passage, anchor, content, least).

    Every window is searched in one shard only, under its shortest anchor that is not hot.
    """
    dealt, cuts = [], []
    for level, size in enumerate(GRAMS[1:]):
        hot = distinct.groupBy("anchor").count().where(F.col("count") > HOT_PASSAGES).select("anchor")
        hot = tables.keep(hot, f"hot-{level}")
        if hot.isEmpty():
            break
        dealt.append(distinct.join(hot, "anchor", "left_anti").select("anchor", "passage", "content", "least"))
        pieces = distinct.join(hot, "anchor", "left_semi").select("anchor", "passage", "content", "least")
        pieces = pieces.mapInArrow(
            _recut_batches(size),
            "whole_anchor long, whole long, window int, anchor long, passage long, content binary, least long",
        )
        cuts.append(tables.keep(pieces, f"pieces-{level}"))
        distinct = cuts[-1].groupBy("passage", "anchor", "content").agg(F.min("least").alias("least"))
        distinct = tables.keep(distinct, f"distinct-{level + 1}")
    dealt.append(distinct.select("anchor", "passage", "content", "least"))

    sizes = [d.agg(F.sum(F.octet_length("content"))).first()[0] or 0 for d in dealt]
    shards = max(-(-sum(sizes) // (WORD_BYTES * SHARD_WORDS)), 1)
    everything = dealt[0]
    for d in dealt[1:]:
        everything = everything.union(d)
    searched = everything.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard")
    reported = tables.keep(searched.applyInArrow(_search_shard, "anchor long, passage long, minima array<long>"), "minima")
    tables.drop(*[f"distinct-{k}" for k in range(len(dealt))], *[f"hot-{k}" for k in range(len(dealt))])

    # the pieces of a passage in their order give its windows, the deepest cut first
    for pieces in reversed(cuts):
        parts = pieces.select("whole_anchor", "whole", "window", "anchor", "passage").join(reported, ["anchor", "passage"])
        in_order = F.sort_array(F.collect_list(F.struct("window", "minima")))
        wholes = parts.groupBy("whole_anchor", "whole").agg(F.flatten(F.transform(in_order, lambda p: p["minima"])))
        reported = reported.union(wholes)
    return reported


def cut_windows(df: DataFrame) -> DataFrame:
    """(row, starts): the first words of the windows to cut, for every row that has any.

    ``row`` is xxhash64(doc_id, text).
    """
    tables = Scratch(df.sparkSession, "fm-index")
    docs = df.where("doc_id is not null and text is not null").select("doc_id", "text")
    # found twice rather than kept: a table of all anchors would be the largest of all
    anchors = docs.mapInArrow(_anchor_batches, "anchor long, doc_id long")
    # a text names an anchor once, so a count tells (rows with one id count twice and only cost a search);
    # a table of its own leaves the join two plain shuffles, which Spark splits where an anchor is hot
    shared = tables.keep(anchors.groupBy("anchor").count().where(F.col("count") > 1).select("anchor"), "shared-anchors")
    lists = anchors.join(shared, "anchor", "left_semi").groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))

    packed = docs.select("text", F.xxhash64("doc_id", "text").alias("row"), "doc_id").mapInArrow(
        _pack_batches, "packed binary, row long, doc_id long"
    )
    found = packed.join(lists, "doc_id").select("packed", "row", "doc_id", "anchors")
    found = tables.keep(
        found.mapInArrow(
            _passage_batches, "row long, doc_id long, start int, anchor long, passage long, content binary"
        ),
        "passages",
    )
    tables.drop("shared-anchors")
    distinct = found.groupBy("passage", "anchor", "content").agg(F.min("doc_id").alias("least"))
    reported = _reported(tables.keep(distinct, "distinct-0"), tables)

    places = found.select("row", "doc_id", "start", "anchor", "passage").join(reported, ["anchor", "passage"])
    first = F.filter(
        F.transform("minima", lambda m, k: F.when(m < F.col("doc_id"), F.col("start") + k)), lambda s: s.isNotNull()
    )
    cut = places.select("row", first.alias("starts")).where(F.size("starts") > 0)
    return cut.groupBy("row").agg(F.flatten(F.collect_list("starts")).alias("starts"))


def _texts_with_cuts(df: DataFrame) -> DataFrame:
    texts = df.select(F.coalesce("text", F.lit("")).alias("text"), "doc_id", F.xxhash64("doc_id", "text").alias("row"))
    packed = texts.mapInArrow(_pack_batches, f"packed binary, doc_id {df.schema['doc_id'].dataType.simpleString()}, row long")
    return packed.join(cut_windows(df), "row", "left").select("packed", "doc_id", "starts")


def dedup_substrings(df: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the kept text (words joined by one space) of every row."""
    cut = _texts_with_cuts(df)
    out = cut.mapInArrow(_cut_batches, "doc_id long, n_words long, n_removed long, kept binary")
    return out.select("doc_id", "n_words", "n_removed", F.col("kept").cast("string").alias("text"))


def op2_dedup(df: DataFrame) -> DataFrame:
    """The contract's columns for a documents table."""
    return _texts_with_cuts(df).mapInArrow(
        _digest_batches, "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )


# The same rows in DuckDB SQL, from all windows.
ORACLE_SQL = """
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 12 + 1)) AS i FROM words WHERE len(w) >= 13),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM starts),
firsts AS (SELECT s, min(doc_id) AS low FROM windows GROUP BY s),
cut AS (SELECT doc_id, unnest(range(i, i + 13)) AS k FROM windows JOIN firsts USING (s) WHERE low < doc_id),
gone AS (SELECT doc_id, list(DISTINCT k) AS ks FROM cut GROUP BY doc_id),
kept AS (
  SELECT words.doc_id, len(w) AS n_words, coalesce(len(ks), 0) AS n_removed,
    list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(coalesce(ks, []), x[2])) AS k
  FROM words LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
  sha256(array_to_string(list_transform(k, lambda x: x[1]), ' ')) AS kept_sha256 FROM kept
"""
