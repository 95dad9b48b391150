"""Operator 8, document fingerprints: SpotSigs.

Wherever a common word (an anchor such as an article or a form of "to be")
occurs, the next ``CHAIN`` content words after it, stop words skipped, form a
signature together with the anchor. Words are runs of letters and digits, A-Z
folded. A fingerprint is the multiset of a text's signatures: the second
occurrence of a signature is an element of its own. A text without a complete
chain has one signature, of all its words. Likeness is the Jaccard similarity of
two fingerprints; two sets of length m <= n can reach m / n at most, which prunes
comparisons before any element is looked at.

``likeness_to_next`` compares every document with its successor by id and with
an edited text that borrows from it. The table is cut into ranges of ids at
approximate quantiles; each range is sorted and streamed by one task, and the
first document of a range is sent to the range before it as well. One shuffle of
the (compressed) texts, no group held in memory.

``similar_pairs`` joins all documents with each other: sets are partitioned by
length so that partners lie in the same or the next partition, candidates share
one of the rarest signatures of both (prefix filter, exact), and the length bound
prunes what is verified.

Defined cases: null counts as empty text; a text without words has the empty
fingerprint, two empty fingerprints have likeness 1, an empty and another 0; a row with a null id has no
successor: nothing replaces the second half of its text and near_next is 0;
rows with equal ids follow one another by their text; the only row of a table is
its own successor; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickmarts.llm.htmltext import STOP_WORDS
from pickmarts.llm.textwords import (
    NOT_ALNUM,
    Texts,
    batches_by_bytes,
    distinct_per_text,
    mix64,
    texts_from_bytes,
    texts_of,
    words_of,
)

# Anchors, the most common articles, prepositions and forms of "to be".
ANCHORS = "a an the is was that of der die das ein ist von le la les un est de el los una es que".split()
CHAIN = 2
DOCS_PER_RANGE = 2048
MOST_RANGES = 4096
CHUNK_BYTES = 2 << 20

_U = np.uint64


def _word_set(words: list[str]) -> np.ndarray:
    return np.sort(words_of(texts_from_bytes([w.encode() for w in words]), lower=True, separators=NOT_ALNUM).hash)


_ANCHORS = _word_set(ANCHORS)
_STOPS = _word_set(sorted(STOP_WORDS | set(ANCHORS)))


def _member(h: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    k = np.minimum(np.searchsorted(sorted_set, h), len(sorted_set) - 1)
    return sorted_set[k] == h


def signatures(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprint of every text: distinct elements, ascending, and the text each belongs to."""
    words = words_of(texts, lower=True, separators=NOT_ALNUM)
    n = len(texts)
    doc = words.doc()
    stop = _member(words.hash, _STOPS)
    content = np.flatnonzero(~stop)
    anchors = np.flatnonzero(stop)
    anchors = anchors[_member(words.hash[anchors], _ANCHORS)]
    j = np.searchsorted(content, anchors)
    full = j + CHAIN <= len(content)
    anchors, j = anchors[full], j[full]
    same = doc[content[j + CHAIN - 1]] == doc[anchors] if len(j) else np.zeros(0, bool)
    anchors, j = anchors[same], j[same]
    h = words.hash[anchors].copy()
    for k in range(CHAIN):
        h = mix64(h * _U(0x2545F4914F6CDD1D)) + words.hash[content[j + k]]
    h, owner = mix64(h), doc[anchors]
    # texts without any chain: all their words in a row
    counts = words.counts()
    lone = np.flatnonzero((np.bincount(owner, minlength=n) == 0) & (counts > 0))
    if len(lone):
        whole = [mix64(np.cumsum(mix64(words.hash[words.first[d] : words.first[d + 1]] + np.arange(counts[d], dtype=np.uint64))))[-1] for d in lone]
        h, owner = np.concatenate([h, np.array(whole, np.uint64)]), np.concatenate([owner, lone])
    # the k-th occurrence of a signature in a text is an element of its own
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    start = np.maximum.accumulate(np.where(fresh, np.arange(len(h)), 0)) if len(h) else np.zeros(0, np.int64)
    times = (np.arange(len(h)) - start).astype(np.uint64)
    return distinct_per_text(mix64(h + times * _U(0x9E3779B97F4A7C15)), owner, n)


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two ascending distinct arrays; 0 if the lengths alone keep it below ``least``."""
    if not len(a) and not len(b):
        return 1.0
    if not len(a) or not len(b) or min(len(a), len(b)) / max(len(a), len(b)) < least:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def _hex(elements: np.ndarray) -> str:
    return (elements >> _U(32)).astype(">u4").tobytes().hex()


def _range_batches(borders: np.ndarray, firsts: dict[int, int]):
    """Pack texts and deal rows to their range; the first ids of a range also go to the range before it."""
    order = sorted(firsts)
    before = {firsts[r]: order[k - 1] for k, r in enumerate(order)}  # the first range follows the last
    first_ids = np.array(sorted(before), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches_by_bytes(batches, "text"):
            texts = texts_of(batch.column(1))
            packed = [pack.compress(texts.raw(i)) for i in range(len(texts))]
            ids = batch.column(0)
            real = np.array(ids.is_valid())
            values = ids.fill_null(0).to_numpy().astype(np.int64)
            spread = np.array([-1 - zlib.crc32(p) % 1024 for p in packed])  # rows without an id stand alone
            block = np.where(real, np.searchsorted(borders, values, side="right"), spread)
            also = np.flatnonzero(real & np.isin(values, first_ids))
            rows = np.concatenate([np.arange(len(texts)), also])
            tail = np.concatenate([np.zeros(len(texts), bool), np.ones(len(also), bool)])
            block = np.concatenate([block, [before[int(values[i])] for i in also]]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block), pa.array(tail), ids.take(pa.array(rows)), pa.array([packed[i] for i in rows], pa.binary())],
                names=["range", "tail", "doc_id", "packed"],
            )

    return run


def _first_batches(borders: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, int] = {}
        for batch in batches:
            ids = np.sort(batch.column(0).to_numpy())
            block, at = np.unique(np.searchsorted(borders, ids, side="right"), return_index=True)
            for b, v in zip(block.tolist(), ids[at].tolist()):
                found[b] = min(v, found.get(b, v))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["range", "first"]
        )

    return run


def _compared(rows: list[tuple[int, bytes]], followed: list[bool]) -> pa.RecordBatch:
    """Result rows of consecutive documents; ``followed[i]``: row i + 1 is the successor of row i, else it has none.

    Rows after the last entry of ``followed`` only serve as successors.
    """
    own = texts_from_bytes([t for _, t in rows])
    edited, lengths = [], []
    for i, follows in enumerate(followed):
        text = rows[i][1].decode("utf-8")
        half = len(text) // 2
        successor = rows[i + 1][1].decode("utf-8") if follows else ""
        edited.append((text[: len(text) - half] + successor[:half]).encode("utf-8"))
        lengths.append(len(text))
    h, doc = signatures(own)
    at = np.searchsorted(doc, np.arange(len(rows) + 1))
    eh, edoc = signatures(texts_from_bytes(edited))
    eat = np.searchsorted(edoc, np.arange(len(edited) + 1))
    sets = [h[a:b] for a, b in zip(at[:-1], at[1:])]
    changed = [eh[a:b] for a, b in zip(eat[:-1], eat[1:])]
    n = len(edited)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows[i][0] for i in range(n)], pa.int64()),
            pa.array(lengths, pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
            pa.array([_hex(sets[i]) for i in range(n)]),
            pa.array([_hex(c) for c in changed]),
            pa.array([likeness(sets[i], changed[i]) for i in range(n)]),
            pa.array([likeness(sets[i], sets[i + 1]) if followed[i] else 0.0 for i in range(n)]),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def _compare_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walks through the sorted rows of ranges; holds about CHUNK_BYTES of text."""
    unpack = zstandard.ZstdDecompressor()
    rows: list[tuple[int | None, bytes]] = []
    followed: list[bool] = []  # of every row but the last
    open_range = None  # range of the last row, while its successor may still come
    held = 0
    for batch in batches:
        for block, tail, doc_id, packed in zip(*[c.to_pylist() for c in batch.columns]):
            same = block == open_range and doc_id is not None
            if tail and not same:
                continue  # a range sent ahead more than its first row, or this range is empty
            if rows:
                followed.append(same)
            text = unpack.decompress(packed)
            rows.append((doc_id, text))
            held += len(text)
            open_range = None if tail else block
            if tail or held > CHUNK_BYTES:
                if followed:
                    yield _compared(rows, followed)
                rows, followed = ([] if tail else rows[-1:]), []
                held = sum(len(t) for _, t in rows)
    if rows:
        yield _compared(rows, [*followed, False])


def likeness_to_next(df: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    ids = df.select("doc_id").where("doc_id is not null")
    n = ids.count()
    ranges = min(MOST_RANGES, -(-n // DOCS_PER_RANGE))
    cuts = [k / ranges for k in range(1, ranges)]
    borders = np.zeros(0, np.int64)
    if cuts:
        found = ids.agg(F.percentile_approx("doc_id", cuts, 10 * MOST_RANGES)).first()[0]
        borders = np.unique(np.array(found, np.int64))
    # at most MOST_RANGES rows
    firsts = ids.mapInArrow(_first_batches(borders), "range long, first long").groupBy("range").agg(F.min("first"))
    firsts = {r[0]: r[1] for r in firsts.collect()}
    dealt = df.select("doc_id", "text").mapInArrow(
        _range_batches(borders, firsts), "range long, tail boolean, doc_id long, packed binary"
    )
    ordered = dealt.repartition("range").sortWithinPartitions("range", "tail", "doc_id", "packed")
    return ordered.mapInArrow(
        _compare_batches,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_by_bytes(batches, "text"):
        texts = texts_of(batch.column(1))
        h, doc = signatures(texts)
        offsets = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.view(np.int64)))],
            names=["doc_id", "elements"],
        )


def similar_pairs(df: DataFrame, least: float = 0.5) -> DataFrame:
    """(doc_id, other_id, likeness) of all pairs of documents with likeness >= ``least``.

    Equal fingerprints are joined once, under their smallest id, and come out as
    pairs with that id; a pair of different fingerprints as a pair of their
    smallest ids.
    """
    found = df.where("doc_id is not null").select("doc_id", "text").mapInArrow(_set_batches, "doc_id long, elements array<long>")
    found = found.where(F.size("elements") > 0)
    # one row per fingerprint; the copies are named by it
    name = F.sha2(F.concat_ws(",", F.col("elements").cast("array<string>")), 256)
    rows = found.select("doc_id", "elements", name.alias("name"))
    reps = rows.groupBy("name").agg(F.min("doc_id").alias("rep"))
    copies = rows.select("doc_id", F.col("name").alias("n")).join(reps, F.col("n") == F.col("name"))
    copies = copies.where("doc_id != rep").select("rep", F.col("doc_id").alias("other"), F.lit(1.0).alias("likeness"))
    sets = rows.join(reps.select(F.col("rep").alias("doc_id"), "name"), ["doc_id", "name"], "left_semi")
    sets = sets.select("doc_id", "elements", F.size("elements").alias("n"))
    step = float(np.log(1 / least)) if least < 1 else 1e-9
    # partners differ in length by a factor 1 / least at most: same or next partition
    partition = F.floor(F.log(F.col("n")) / step + 1e-9).cast("int")
    elements = sets.select("doc_id", "n", partition.alias("part"), F.explode("elements").alias("e"))
    often = elements.groupBy("e").agg(F.count("*").alias("df")).where("df > 1").select(F.col("e").alias("e2"), "df")
    shared = elements.join(often, F.col("e") == F.col("e2"))
    in_doc = Window.partitionBy("doc_id")
    place = F.row_number().over(in_doc.orderBy("df", "e")) + F.col("n") - F.count("*").over(in_doc)
    prefix = shared.withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * least) + 1)
    prefix = prefix.select("doc_id", "n", "part", "e")
    probe = prefix.select(
        F.col("doc_id").alias("other"),
        F.col("n").alias("m"),
        F.col("e").alias("e2"),
        F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part2"),
    )
    longer = (F.col("m") > F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("other") > F.col("doc_id")))
    met = (F.col("e") == F.col("e2")) & (F.col("part") == F.col("part2")) & longer & (F.col("n") >= F.col("m") * least)
    pairs = prefix.join(probe, met).select("doc_id", "other").distinct()
    left = sets.select("doc_id", F.col("elements").alias("a"))
    right = sets.select(F.col("doc_id").alias("other"), F.col("elements").alias("b"))
    common = F.size(F.array_intersect("a", "b"))
    verified = pairs.join(left, "doc_id").join(right, "other").withColumn("c", common)
    verified = verified.select(
        F.least("doc_id", "other").alias("rep"),
        F.greatest("doc_id", "other").alias("other"),
        (F.col("c") / (F.size("a") + F.size("b") - F.col("c"))).alias("likeness"),
    ).where(F.col("likeness") >= least)
    both = copies.unionByName(verified)
    return both.select(F.col("rep").alias("doc_id"), F.col("other").alias("other_id"), "likeness")
