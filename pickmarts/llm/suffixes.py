"""Operator 11, suffix-array dedup by distributed prefix doubling.

A byte goes if a string of ``threshold`` bytes over it also starts anywhere else,
in the same or another text. All strings are judged on the input.

The positions of a suffix array are all bytes of the corpus; only those whose
string can occur twice need a rank. They are found in two steps, both exact:

1. Of the ``coarse``-byte substrings inside a string the leftmost with the
   smallest hash is its anchor, so equal strings have equal anchors. Anchors are
   counted (map-side first); strings whose anchor stands once are unique. The
   others go on. They are recognised in the texts by a bit filter of
   ``FILTER_BITS``, a fixed size; what passes by chance costs a row, no more.
2. Consecutive strings with one ``fine``-byte anchor form a passage, named by the
   anchor and a hash of its content by another base (128 bits together). Equal
   passages are one row with a count. A passage that stands twice is repeated
   whole; one that stands once, alone with its anchor, is unique whole.

What is left are different passages around one anchor. Their positions are
ranked by prefix doubling: the first ranks are hashes of ``first`` bytes; in each
round the pairs (rank, rank at +offset) are sorted by Spark over all tasks, equal
pairs get one new rank, for a prefix of twice the length, and positions with a
rank of their own leave. Offsets double until the prefix is the whole string. The
sort ends with the position itself, so a pair that a third of all positions
share is spread over tasks; runs that cross the border of two tasks are joined
by a table of two rows a task. Pairs are compared beside their anchor, so hashes
of first prefixes need only differ inside the passages of one anchor.

Repeated strings meet the occurrences of their passage by a join, and the bytes
they cover are cut from the texts. Very long texts are read in pieces of
``piece`` bytes that overlap by a string less one byte.

Defined cases: null counts as the empty text; texts shorter than a string lose
nothing; rows with equal or null ids are rows like any other, and repeated rows
are copies of each other; an empty table gives an empty result; other columns are
ignored, whatever their names. Cuts may split a character, so kept texts are
bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickmarts.llm.columns import Scratch
from pickmarts.llm.textwords import Texts, batches_by_bytes, mix64, texts_from_bytes, texts_of

FILTER_BITS = 1 << 26

_U = np.uint64
_I = np.int64
_HIGH = _U(0xFFFFFFFF00000000)
_LOW = _U(0x00000000FFFFFFFF)


@dataclass(frozen=True)
class Lengths:
    """Bytes of a string, of the first ranks (a power of two fits them in a string), of both anchors and of a piece."""

    threshold: int = 400
    first: int = 100
    coarse: int = 200
    fine: int = 350
    piece: int = 1 << 20

    def __post_init__(self) -> None:
        parts = self.threshold // self.first
        if parts < 2 or parts & (parts - 1) or parts * self.first != self.threshold:
            raise ValueError("threshold must be first times 2, 4, 8, ...")
        if not 0 < self.coarse <= self.fine <= self.threshold:
            raise ValueError("0 < coarse <= fine <= threshold")


class _Roll:
    """Hashes of substrings as differences of one running sum, modulo 2^64."""

    def __init__(self, seed: int):
        self.base = seed | 1
        self.codes = mix64(np.arange(1, 257, dtype=np.uint64) * _U(seed & (2**64 - 1)))
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if len(self.up) <= n:
            size = 1 << (n + 1).bit_length()
            powers = []
            for base in (self.base, pow(self.base, -1, 1 << 64)):
                p = np.full(size, _U(base & (2**64 - 1)))
                p[0] = 1
                powers.append(np.multiply.accumulate(p))
            self.up, self.down = powers
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(self.codes[data] * self.up[:n], out=out[1:])
        return out

    def grams(self, sums: np.ndarray, size: int) -> np.ndarray:
        """Hash of every substring of ``size`` bytes."""
        if len(sums) <= size:
            return np.zeros(0, np.uint64)
        return mix64((sums[size:] - sums[:-size]) * self.down[: len(sums) - size])

    def spans(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((sums[end] - sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64))


_ANCHOR = _Roll(0x9E3779B97F4A7C15)
_NAME = _Roll(0xD1342543DE82EF95)


@dataclass
class Piece:
    """Some whole texts of a batch, or a part of one long text: ``base`` bytes of it come before."""

    data: np.ndarray
    offsets: np.ndarray
    rows: np.ndarray
    base: int

    def strings(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Text and first byte of every substring of ``size`` bytes."""
        counts = np.maximum(np.diff(self.offsets) - size + 1, 0)
        text = np.repeat(np.arange(len(counts)), counts)
        return text, np.arange(counts.sum()) - (np.cumsum(counts) - counts - self.offsets[:-1])[text]


def pieces(texts: Texts, lengths: Lengths) -> Iterator[Piece]:
    """Every string lies in exactly one piece."""
    size, most = lengths.threshold, lengths.piece
    offsets, i = texts.offsets, 0
    while i < len(texts):
        length = offsets[i + 1] - offsets[i]
        if length > most:
            for base in range(0, int(length), most):
                part = texts.data[offsets[i] + base : min(offsets[i] + base + most + size - 1, offsets[i + 1])]
                yield Piece(part, np.array([0, len(part)]), np.array([i]), base)
            i += 1
        else:
            j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
            yield Piece(texts.data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], np.arange(i, j), 0)
            i = j


def _leftmost_least(h: np.ndarray, span: int) -> np.ndarray:
    """Place of the leftmost smallest hash (upper half) in every stretch of ``span``."""
    key, reach = (h & _HIGH) | np.arange(len(h), dtype=np.uint64), 1
    while reach < span:
        step = min(reach, span - reach)
        key = np.minimum(key[: len(key) - step], key[step:])
        reach += step
    return (key & _LOW).astype(_I)


def _anchored(piece: Piece, size: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text, first byte, anchor place and anchor hash of every string."""
    text, start = piece.strings(size)
    if not len(start):
        return text, start, start, np.zeros(0, np.uint64)
    h = _ANCHOR.grams(_ANCHOR.sums(piece.data), gram)
    at = _leftmost_least(h, size - gram + 1)[start]
    return text, start, at, h[at]


class BitFilter:
    """Which numbers were put in, with some others by chance; ``FILTER_BITS`` bits whatever their number."""

    def __init__(self, df: DataFrame, column: str):
        word = F.floor(F.pmod(F.col(column), F.lit(FILTER_BITS)) / 64).alias("word")
        bit = F.expr(f"shiftleft(1L, cast(pmod({column}, 64) as int))")
        table = df.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
        bits = np.zeros(FILTER_BITS // 64, np.uint64)
        bits[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
        self.bits = df.sparkSession.sparkContext.broadcast(bits)

    def has(self, h: np.ndarray) -> np.ndarray:
        h = h & _U(FILTER_BITS - 1)
        return (self.bits.value[(h >> _U(6)).astype(_I)] >> (h & _U(63))) & _U(1) == 1


def _anchor_counter(lengths: Lengths):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_bytes(batches, "text"):
            found = []
            for piece in pieces(texts_of(batch.column(0)), lengths):
                _, _, at, h = _anchored(piece, lengths.threshold, lengths.coarse)
                found.append(h[np.flatnonzero(np.diff(at, prepend=-1))])
            anchor, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(_I)), pa.array(n)], names=["anchor", "n"])

    return run


@dataclass
class Passages:
    """Runs of strings with one fine anchor whose coarse anchors passed the filter."""

    text: np.ndarray
    begin: np.ndarray  # in the piece
    strings: np.ndarray
    anchor: np.ndarray
    name: np.ndarray


def _passages(piece: Piece, lengths: Lengths, shared: BitFilter) -> Passages | None:
    text, start, _, coarse = _anchored(piece, lengths.threshold, lengths.coarse)
    use = np.flatnonzero(shared.has(coarse)) if len(start) else np.zeros(0, _I)
    if not len(use):
        return None
    text, start = text[use], start[use]
    h = _ANCHOR.grams(_ANCHOR.sums(piece.data), lengths.fine)
    at = _leftmost_least(h, lengths.threshold - lengths.fine + 1)[start]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (np.diff(start) != 1) | (np.diff(text) != 0)
    first = np.flatnonzero(fresh)
    strings = np.diff(np.append(first, len(at)))
    begin = start[first]
    name = _NAME.spans(_NAME.sums(piece.data), begin, begin + strings + lengths.threshold - 1)
    return Passages(text[first], begin, strings, h[at[first]], name)


def _places(found: Passages, piece: Piece, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte in the whole text, and a number for the place of an occurrence."""
    start = found.begin - piece.offsets[found.text] + piece.base
    row = rows[piece.rows[found.text]].astype(_I).view(np.uint64)
    return start, mix64(row + mix64(start.astype(np.uint64)))


def _passage_finder(lengths: Lengths, shared: BitFilter):
    """(doc_id, row, start, strings, anchor, name, place) of every passage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_bytes(batches, "text"):
            rows = batch.column(2).to_numpy()
            for piece in pieces(texts_of(batch.column(0)), lengths):
                found = _passages(piece, lengths, shared)
                if found is None:
                    continue
                start, place = _places(found, piece, rows)
                owner = pa.array(piece.rows[found.text])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).take(owner),
                        batch.column(2).take(owner),
                        pa.array(start),
                        pa.array(found.strings.astype(np.int32)),
                        pa.array(found.anchor.view(_I)),
                        pa.array(found.name.view(_I)),
                        pa.array(place.view(_I)),
                    ],
                    names=["doc_id", "row", "start", "strings", "anchor", "name", "place"],
                )

    return run


def _content_finder(lengths: Lengths, shared: BitFilter, wanted: BitFilter):
    """(anchor, name, place, content) of the passages whose place is wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_bytes(batches, "text"):
            rows = batch.column(1).to_numpy()
            for piece in pieces(texts_of(batch.column(0)), lengths):
                found = _passages(piece, lengths, shared)
                if found is None:
                    continue
                _, place = _places(found, piece, rows)
                use = np.flatnonzero(wanted.has(place))
                if not len(use):
                    continue
                begin = found.begin[use]
                end = begin + found.strings[use] + lengths.threshold - 1
                data = piece.data.tobytes()
                content = [data[x:y] for x, y in zip(begin.tolist(), end.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.anchor[use].view(_I)),
                        pa.array(found.name[use].view(_I)),
                        pa.array(place[use].view(_I)),
                        pa.array(content, pa.binary()),
                    ],
                    names=["anchor", "name", "place", "content"],
                )

    return run


def _few_rows(batches: Iterator[pa.RecordBatch], most: int = 2048) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, most):
            yield batch.slice(i, most)


def _first_pairs(lengths: Lengths):
    """(anchor, a, b, name, start, part): the first pairs of ranks, for all parts of every string.

    Part p of a string begins ``2 * first * p`` bytes after it.
    """
    first, parts = lengths.first, lengths.threshold // lengths.first // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few_rows(batches):
            contents = texts_from_bytes(batch.column(2).to_pylist())
            whole = Piece(contents.data, contents.offsets, np.arange(len(contents)), 0)
            row, begin = whole.strings(lengths.threshold)
            h = _NAME.grams(_NAME.sums(contents.data), first)
            row, begin = np.repeat(row, parts), np.repeat(begin, parts)
            part = np.tile(np.arange(parts), len(row) // parts)
            at = begin + 2 * first * part
            owner = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(owner),
                    pa.array(h[at].view(_I)),
                    pa.array(h[at + first].view(_I)),
                    batch.column(1).take(owner),
                    pa.array((begin - contents.offsets[row]).astype(np.int32)),
                    pa.array(part.astype(np.int32)),
                ],
                names=["anchor", "a", "b", "name", "start", "part"],
            )

    return run


_RANKED = pa.schema(
    [("anchor", pa.int64()), ("name", pa.int64()), ("start", pa.int32()), ("part", pa.int32())]
    + [(c, pa.int64()) for c in ("rank", "a", "b", "n")]
)


def _rank_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks of one task's sorted pairs; rows whose pair stands once in the task's inside are left out.

    The first and the last pair may go on in a neighbouring task: their rows stay,
    and a row without a name gives the pair and how often it stood.
    """
    rank = (TaskContext.get().partitionId() << 33) - 1
    key, count = None, 0  # of the open run
    held = None  # its row, while it is the only one
    first = None  # key, rank and count of the task's first run

    def rows(batch: pa.RecordBatch, ranks: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(batch.num_rows, pa.int64())
        return pa.RecordBatch.from_arrays(
            [*(batch.column(batch.schema.get_field_index(c)) for c in ("anchor", "name", "start", "part"))]
            + [pa.array(ranks), none, none, none],
            schema=_RANKED,
        )

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("anchor", "a", "b")])
        fresh = np.ones(n, bool)
        fresh[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
        fresh[0] = key is None or tuple(keys[:, 0].tolist()) != key
        run = np.cumsum(fresh)  # 0: the open run
        sizes = np.bincount(run, minlength=run[-1] + 1)
        if not fresh[0]:
            if held is not None:
                yield held
            sizes[0] += count
        held = None
        if first is None:
            first = [tuple(keys[:, 0].tolist()), rank + 1, 0]
        if rank + run[0] == first[1]:
            first[2] = int(sizes[run[0]])
        keep = sizes[run] > 1
        keep |= rank + run == first[1]
        out = np.flatnonzero(keep)
        if len(out):
            yield rows(batch.take(pa.array(out)), rank + run[out])
        key, count, rank = tuple(keys[:, -1].tolist()), int(sizes[-1]), rank + int(run[-1])
        if not keep[-1]:
            held = rows(batch.slice(n - 1), np.array([rank]))
    if first is None:
        return
    if held is not None:
        yield held
    border = [first] if first[1] == rank else [first, [key, rank, count]]
    nothing = [None] * len(border)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(v, t)
            for v, t in zip(
                [[x[0][0] for x in border], nothing, nothing, nothing, [x[1] for x in border]]
                + [[x[0][1] for x in border], [x[0][2] for x in border], [x[2] for x in border]],
                _RANKED.types,
            )
        ],
        schema=_RANKED,
    )


def reranked(pairs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(anchor, name, start, part, rank) of the rows whose pair (a, b) stands more than once with their anchor.

    Equal pairs have equal ranks. ``pairs`` has the columns anchor, a, b, name, start, part.
    """
    order = ["anchor", "a", "b", "name", "start", "part"]
    spread = pairs.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "anchor long, name long, start int, part int, rank long, a long, b long, n long"
    ranked = scratch.keep(spread.mapInArrow(_rank_batches, schema), name)
    # at most two rows a task: runs that cross tasks get the least of their ranks, those of one row go
    borders: dict[tuple, list[tuple[int, int]]] = {}
    for r in ranked.where("n is not null").select("anchor", "a", "b", "rank", "n").collect():
        borders.setdefault((r["anchor"], r["a"], r["b"]), []).append((r["rank"], r["n"]))
    changes = []
    for runs in borders.values():
        least = min(runs)[0] if sum(n for _, n in runs) > 1 else None
        changes += [(rank, least) for rank, _ in runs if rank != least]
    rows = ranked.where("n is null").select("anchor", "name", "start", "part", "rank")
    if not changes:
        return rows
    fixed = F.broadcast(pairs.sparkSession.createDataFrame(changes, "was long, now long"))
    rows = rows.join(fixed, F.col("rank") == F.col("was"), "left")
    return rows.where("was is null or now is not null").select(
        "anchor", "name", "start", "part", F.coalesce("now", "rank").alias("rank")
    )


def _repeated_strings(contents: DataFrame, lengths: Lengths, scratch: Scratch) -> DataFrame:
    """(anchor, name, start) of the strings that stand more than once in the passages, by prefix doubling."""
    pairs = contents.select("anchor", "name", "content").mapInArrow(
        _first_pairs(lengths), "anchor long, a long, b long, name long, start int, part int"
    )
    parts, last = lengths.threshold // lengths.first // 2, None
    while True:
        ranks = reranked(pairs, scratch, f"ranks-{parts}")
        if last:
            scratch.drop(last)
        if parts == 1:
            return ranks.select("anchor", "name", "start")
        last, parts = f"ranks-{parts}", parts // 2
        halves = [F.min(F.when(F.col("part") % 2 == h, F.col("rank"))).alias(c) for h, c in ((0, "a"), (1, "b"))]
        pairs = ranks.groupBy("anchor", "name", "start", F.expr("part div 2").cast("int").alias("half")).agg(*halves)
        pairs = pairs.where("a is not null and b is not null").select(
            "anchor", "a", "b", "name", "start", F.col("half").alias("part")
        )


def repeated_spans(df: DataFrame, lengths: Lengths, scratch: Scratch) -> DataFrame:
    """(doc_id, row, spans): the strings to cut from every text that has any, ``row`` being its xxhash64(doc_id, text).

    A span is the first byte of a run of strings and their number.
    """
    docs = df.where("text is not null").select("text", "doc_id", F.xxhash64("doc_id", "text").alias("row"))
    anchors = docs.select("text").mapInArrow(_anchor_counter(lengths), "anchor long, n long")
    anchors = anchors.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    shared = BitFilter(scratch.keep(anchors, "anchors"), "anchor")
    scratch.drop("anchors")

    kind = df.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, row long, start long, strings int, anchor long, name long, place long"
    found = scratch.keep(docs.mapInArrow(_passage_finder(lengths, shared), schema), "passages")
    passages = found.groupBy("anchor", "name").agg(F.count("*").alias("n"), F.min("place").alias("place"))
    passages = scratch.keep(passages, "distinct")

    several = passages.groupBy("anchor").agg(F.count("*").alias("names")).where("names > 1")
    several = scratch.keep(several.select(F.col("anchor").alias("of")), "several")
    unlike = passages.join(several, F.col("anchor") == F.col("of"), "left_semi").select("anchor", "name", "place")
    unlike = scratch.keep(unlike, "unlike")
    texts = docs.select("text", "row").mapInArrow(
        _content_finder(lengths, shared, BitFilter(unlike, "place")), "anchor long, name long, place long, content binary"
    )
    texts = texts.join(unlike, ["anchor", "name", "place"], "left_semi").dropDuplicates(["anchor", "name"])
    contents = scratch.keep(texts.select("anchor", "name", "content"), "contents")

    strings = _repeated_strings(contents, lengths, scratch)
    strings = strings.groupBy("anchor", "name").agg(F.collect_set("start").alias("some"))
    whole = passages.where("n > 1").select("anchor", "name", F.lit(None).cast("array<int>").alias("some"))
    once = passages.where("n = 1").select(F.col("anchor").alias("a1"), F.col("name").alias("n1"))
    single = strings.join(once, (F.col("anchor") == F.col("a1")) & (F.col("name") == F.col("n1")), "left_semi")
    cuts = scratch.keep(whole.union(single.select("anchor", "name", "some")), "cuts")
    scratch.drop("distinct", "several", "unlike", "contents", "ranks-1")

    cuts = cuts.select(F.col("anchor").alias("a2"), F.col("name").alias("n2"), "some")
    places = found.join(cuts, (F.col("anchor") == F.col("a2")) & (F.col("name") == F.col("n2")))
    span = "struct(start + cast(s as long) as first, 1 as strings)"
    spans = F.expr(f"if(some is null, array(struct(start as first, strings)), transform(some, s -> {span}))")
    places = places.select("doc_id", "row", spans.alias("spans"))
    return places.groupBy("doc_id", "row").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def _pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches_by_bytes(batches, "text"):
        texts = texts_of(batch.column(0))
        packed = pa.array([pack.compress(texts.raw(i)) for i in range(len(texts))], pa.large_binary())
        yield pa.RecordBatch.from_arrays(
            [packed.cast(pa.binary()), *batch.columns[1:]], names=["packed", *batch.schema.names[1:]]
        )


def _without_spans(text: bytes, first: np.ndarray, strings: np.ndarray, size: int) -> tuple[bytes, list[tuple[int, int]]]:
    """The text without the bytes its strings cover, and the maximal removed runs."""
    edge = np.zeros(len(text) + 1, np.int32)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + strings + size - 1, -1)
    gone = np.cumsum(edge) > 0
    turns = np.flatnonzero(np.diff(gone, prepend=False))
    kept = np.frombuffer(text, np.uint8)[~gone[:-1]].tobytes()
    return kept, list(zip(turns[::2].tolist(), turns[1::2].tolist()))


def _cutter(size: int):
    """(doc_id, n_bytes, n_removed, spans, kept) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                text = unpack.decompress(one.column(0)[0].as_py())
                spans = one.column(2)
                kept, runs = text, []
                if spans.null_count == 0 and len(spans.flatten()):
                    flat = spans.flatten()
                    first, strings = flat.field(0).to_numpy(), flat.field(1).to_numpy()
                    kept, runs = _without_spans(text, first, strings.astype(_I), size)
                yield pa.RecordBatch.from_arrays(
                    [
                        one.column(1),
                        pa.array([len(text)], pa.int64()),
                        pa.array([len(text) - len(kept)], pa.int64()),
                        pa.array([[{"first": x, "end": y} for x, y in runs]], _SPANS),
                        pa.array([kept], pa.binary()),
                    ],
                    names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
                )

    return run


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def _digester(size: int):
    cut = _cutter(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[pa.RecordBatch] = []

        def out() -> pa.RecordBatch:
            t = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            rows.clear()
            return t

        for batch in cut(batches):
            digest = pa.array([hashlib.sha256(batch.column(4)[0].as_py()).hexdigest()])
            spans = pa.array([len(batch.column(3)[0])], pa.int64())
            rows.append(pa.RecordBatch.from_arrays(
                [*batch.columns[:3], spans, digest], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            ))
            if len(rows) == 1024:
                yield out()
        if rows:
            yield out()

    return run


def _texts_with_spans(df: DataFrame, lengths: Lengths) -> DataFrame:
    scratch = Scratch(df.sparkSession, "suffixes")
    spans = repeated_spans(df, lengths, scratch).select(F.col("doc_id").alias("d2"), F.col("row").alias("r2"), "spans")
    texts = df.select(F.coalesce("text", F.lit("")).alias("text"), "doc_id", F.xxhash64("doc_id", "text").alias("row"))
    kind = df.schema["doc_id"].dataType.simpleString()
    packed = texts.mapInArrow(_pack_batches, f"packed binary, doc_id {kind}, row long")
    same = F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("row") == F.col("r2"))
    return packed.join(spans, same, "left").select("packed", "doc_id", "spans")


def dedup_bytes(df: DataFrame, lengths: Lengths = Lengths()) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (first byte and end of each removed run) and kept bytes of every row."""
    kind = df.schema["doc_id"].dataType.simpleString()
    return _texts_with_spans(df, lengths).mapInArrow(
        _cutter(lengths.threshold),
        f"doc_id {kind}, n_bytes long, n_removed long, spans array<struct<first: long, end: long>>, kept binary",
    )


def op11_dedup(df: DataFrame, lengths: Lengths = Lengths()) -> DataFrame:
    """The contract's columns for a documents table."""
    kind = df.schema["doc_id"].dataType.simpleString()
    return _texts_with_spans(df, lengths).mapInArrow(
        _digester(lengths.threshold), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def _oracle_sql(threshold: int = 400) -> str:
    """The same rows in DuckDB SQL: prefix doubling over all bytes, from one byte on."""
    rounds, h = "", 1
    while 2 * h < threshold:
        rounds += f"""
r{2 * h} AS MATERIALIZED (SELECT r, n, i, b, dense_rank() OVER (ORDER BY k, k2) AS k
  FROM (SELECT *, lead(k, {h}, 0) OVER (PARTITION BY r ORDER BY i) AS k2 FROM r{h})),"""
        h *= 2
    return f"""
WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS t FROM documents),
bytes AS (SELECT r, octet_length(t) AS n, unnest(range(octet_length(t))) AS i, unnest(regexp_extract_all(hex(t), '..')) AS b FROM texts),
r1 AS MATERIALIZED (SELECT r, n, i, b, ('0x' || b)::INT AS k FROM bytes),{rounds}
pairs AS (SELECT *, lead(k, {threshold - h}, 0) OVER (PARTITION BY r ORDER BY i) AS k2 FROM r{h}),
counted AS (SELECT r, i, b, CASE WHEN i + {threshold} <= n THEN count(*) OVER (PARTITION BY k, k2, i + {threshold} <= n) ELSE 0 END AS c FROM pairs),
gone AS (SELECT r, i, b, max(c) OVER (PARTITION BY r ORDER BY i ROWS {threshold - 1} PRECEDING) > 1 AS g FROM counted),
runs AS (SELECT *, g AND NOT lag(g, 1, false) OVER (PARTITION BY r ORDER BY i) AS f FROM gone),
cut AS (SELECT r, count(*) FILTER (g) AS n_removed, count(*) FILTER (f) AS n_spans,
  string_agg(b, '' ORDER BY i) FILTER (NOT g) AS kept FROM runs GROUP BY r)
SELECT doc_id, octet_length(t)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM texts LEFT JOIN cut USING (r)
"""


ORACLE_SQL = _oracle_sql()
