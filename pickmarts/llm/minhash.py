"""Operator 4, MinHash near-dedup by fast similarity sketching.

A text's set holds its distinct shingles of five words (A-Z folded; a shorter
text counts as one shingle). The sketch has ``t`` coordinates. In round i < t
every element is thrown into a random coordinate with value (i, hash); in round
t <= i < 2t every element goes to coordinate i - t, so after 2t rounds at the
latest each coordinate is filled; rounds stop as soon as all are. A coordinate
keeps its smallest value, and two sketches agree in a coordinate with
probability equal to the Jaccard similarity, with concentration bounds like
those of independent hashes at the cost of one pass for large sets.

1. Equal sets are one node, named by its smallest doc_id (counted map-side).
2. Banding: ``BANDS`` keys of ``ROWS`` coordinates. A pair at similarity 0.75
   shares no band with probability 8e-6. In every bucket each member is paired
   with the smallest one (a star, not all pairs).
3. Exact verification on the full shingle sets, then connected components.
4. A star can miss links between members that both differ from its centre. They
   can only be left in buckets that still hold several components; the documents
   of those buckets go through an exact prefix filter (two sets at 0.75 or more
   share one of their rarest shingles), across components only, and the pairs
   found are verified and merged in the same way. Nothing is capped.

Defined cases: null or blank text has an empty set and is linked with nothing;
rows with a null id are linked with nothing (component null, kept); rows with
equal ids count as one document; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pickmarts.llm.columns import fresh_prefix, written
from pickmarts.llm.components import components
from pickmarts.llm.textwords import (
    Texts,
    batches_by_bytes,
    distinct_per_text,
    mix64,
    ngram_hashes,
    texts_from_bytes,
    texts_of,
    words_of,
)

SHINGLE = 5
BANDS = 60
ROWS = 6
# the link rule: 100 * intersection >= 75 * union
SHARE = 75

_U = np.uint64
_LOW48 = _U((1 << 48) - 1)


def shingle_sets(texts: Texts, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, and the text each belongs to (both ascending per text)."""
    h, doc, _ = ngram_hashes(words_of(texts, lower=True), size, short_whole=True)
    return distinct_per_text(h, doc, len(texts))


def sketches(h: np.ndarray, doc: np.ndarray, n_texts: int, t: int) -> np.ndarray:
    """``t`` coordinates for every text (all ones for an empty set)."""
    out = np.full(n_texts * t, _U(2**64 - 1))
    sizes = np.bincount(doc, minlength=n_texts)
    open_ = np.flatnonzero(sizes)
    for i in range(2 * t):
        if not len(h):
            break
        r = mix64(h + _U((i + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        value = (_U(i) << _U(48)) | (r & _LOW48)
        place = (r >> _U(48)).astype(np.int64) * t >> 16 if i < t else np.full(len(h), i - t)
        np.minimum.at(out, doc * t + place, value)
        # texts with every coordinate filled leave the game
        filled = (out.reshape(n_texts, t)[open_] != _U(2**64 - 1)).all(axis=1)
        if filled.any():
            open_ = open_[~filled]
            live = np.zeros(n_texts, bool)
            live[open_] = True
            keep = live[doc]
            h, doc = h[keep], doc[keep]
    return out.reshape(n_texts, t)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; equal keys mean equal coordinates in that band."""
    n = len(sketch)
    parts = sketch.reshape(n, bands, rows)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (n, 1))
    for k in range(rows):
        key = mix64(key * _U(0x2545F4914F6CDD1D) + parts[:, :, k])
    return key


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_by_bytes(batches, "text", most=1 << 20):
        texts = texts_of(batch.column(1))
        n = len(texts)
        h, doc = shingle_sets(texts)
        first = np.searchsorted(doc, np.arange(n + 1))
        sums = []
        for salt in (1, 2):
            running = np.zeros(len(h) + 1, np.uint64)
            np.cumsum(mix64(h ^ _U(salt * 0xA0761D6478BD642F & (2**64 - 1))), out=running[1:])
            sums.append((running[first[1:]] - running[first[:-1]]).view(np.int64))
        keys = band_keys(sketches(h, doc, n, BANDS * ROWS), BANDS, ROWS).view(np.int64)
        full = np.diff(first) > 0
        offsets = np.concatenate([[0], np.cumsum(np.where(full, BANDS, 0))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(np.diff(first)),
                pa.array(sums[0]),
                pa.array(sums[1]),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[full].ravel())),
            ],
            names=["doc_id", "n", "h1", "h2", "bands"],
        )


def _pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches_by_bytes(batches, "text"):
        texts = texts_of(batch.column(1))
        packed = [pack.compress(texts.raw(i)) for i in range(len(texts))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["doc_id", "packed"])


def _slices(batch: pa.RecordBatch, names: list[str], most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Slices with about ``most`` packed bytes."""
    sizes = sum(np.array([len(x) for x in batch.column(batch.schema.get_field_index(c)).to_pylist()]) for c in names)
    group = np.cumsum(sizes) // most
    for g in np.unique(group):
        at = np.flatnonzero(group == g)
        yield batch.slice(at[0], len(at))


def _unpacked_sets(ids: np.ndarray, packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids, all their shingles one set after the other, and where each set starts."""
    unpack = zstandard.ZstdDecompressor()
    one, at = np.unique(ids, return_index=True)
    h, doc = shingle_sets(texts_from_bytes([unpack.decompress(packed[i]) for i in at]))
    return one, h, np.searchsorted(doc, np.arange(len(one) + 1))


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        for part in _slices(batch, ["packed_u", "packed_v"]):
            u, v = part.column(0).to_numpy(), part.column(1).to_numpy()
            packed = part.column(2).to_pylist() + part.column(3).to_pylist()
            ids, h, first = _unpacked_sets(np.concatenate([u, v]), packed)
            linked = np.zeros(len(u), bool)
            for k, (a, b) in enumerate(zip(np.searchsorted(ids, u), np.searchsorted(ids, v))):
                x, y = h[first[a] : first[a + 1]], h[first[b] : first[b + 1]]
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked[k] = 100 * common >= SHARE * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([pa.array(u[linked]), pa.array(v[linked])], names=["u", "v"])


def _token_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        for part in _slices(batch, ["packed"]):
            ids, h, first = _unpacked_sets(part.column(0).to_numpy(), part.column(1).to_pylist())
            doc = np.repeat(ids, np.diff(first))
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(h.view(np.int64))], names=["doc", "token"])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) that the full sets confirm."""
    left = texts.select(F.col("doc_id").alias("u"), F.col("packed").alias("packed_u"))
    right = texts.select(F.col("doc_id").alias("v"), F.col("packed").alias("packed_v"))
    full = pairs.join(left, "u").join(right, "v").select("u", "v", "packed_u", "packed_v")
    return full.mapInArrow(_verify_batches, "u long, v long")


def _near_sizes(a: str, b: str) -> Column:
    return (F.col(a) * 100 >= F.col(b) * SHARE) & (F.col(b) * 100 >= F.col(a) * SHARE)


def _prefix_pairs(active: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (u, v) of different components that share one of the rarest shingles of both.

    ``active``: doc, n, comp. Exact: sets with 100 * common >= SHARE * union have
    at least a = ceil(SHARE * (n1 + n2) / (100 + SHARE)) shingles in common, so
    one of the n - a + 1 rarest of either set (in one order for all) is shared.
    """
    tokens = texts.join(active, texts["doc_id"] == active["doc"], "left_semi").mapInArrow(
        _token_batches, "doc long, token long"
    )
    tokens = written(tokens, "tokens")
    often = tokens.groupBy("token").agg(F.count("*").alias("df"))
    often = often.where("df > 1").select(F.col("token").alias("__t"), "df")
    shared = tokens.join(often, F.col("token") == F.col("__t")).select("doc", "token", "df").join(active, "doc")
    # shingles of one document only come first and can't be shared: count them, don't carry them
    in_doc = Window.partitionBy("doc")
    place = F.row_number().over(in_doc.orderBy("df", "token")) + F.col("n") - F.count("*").over(in_doc)
    shared = shared.withColumn("place", place)
    longest = F.col("n") - F.ceil(F.col("n") * SHARE / 100) + 1
    prefix = written(shared.where(F.col("place") <= longest), "prefix")
    several = prefix.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
    # tables between the aggregate, the joins and each other leave every join two plain shuffles, which Spark splits
    # where a token is hot
    several = written(several.select(F.col("token").alias("__t"), "low"), "several")
    right = prefix.select(*[F.col(c).alias(f"{c}2") for c in ("doc", "token", "n", "comp", "place")])
    # every pair across components has a side outside the token's lowest component
    left = prefix.join(several, F.col("token") == F.col("__t")).where("comp != low")
    left = written(left.select("doc", "token", "n", "comp", "place"), "minor")
    common = F.ceil((F.col("n") + F.col("n2")) * SHARE / (100 + SHARE))
    met = (
        (F.col("token") == F.col("token2"))
        & (F.col("comp") != F.col("comp2"))
        & _near_sizes("n", "n2")
        & (F.col("place") <= F.col("n") - common + 1)
        & (F.col("place2") <= F.col("n2") - common + 1)
    )
    pairs = left.join(right, met).select(F.greatest("doc", "doc2").alias("u"), F.least("doc", "doc2").alias("v"))
    return pairs.distinct()


def near_duplicates(df: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of a table with doc_id (long) and text."""
    docs = df.select("doc_id", "text")
    rows = written(docs.mapInArrow(_sketch_batches, "doc_id long, n long, h1 long, h2 long, bands array<long>"), "sketches")
    real = rows.where("n > 0 and doc_id is not null")
    sets = real.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"))
    reps = sets.select(F.col("rep").alias("doc_id"), F.col("h1").alias("r1"), F.col("h2").alias("r2"))
    same = (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")) & (real["doc_id"] == reps["doc_id"])
    keys = real.join(reps, same, "left_semi").select("doc_id", "n", F.explode("bands").alias("key"))

    buckets = keys.groupBy("key").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("last"))
    buckets = written(buckets.where("centre != last").select(F.col("key").alias("__k"), "centre"), "centres")
    members = written(keys.join(buckets, F.col("key") == F.col("__k")).select("key", "doc_id", "n", "centre"), "buckets")
    sizes = sets.select(F.col("rep").alias("__rep"), F.col("n").alias("n_centre"))
    stars = members.where("doc_id != centre").select("doc_id", "n", "centre").distinct()
    stars = stars.join(sizes, F.col("centre") == F.col("__rep")).where(_near_sizes("n", "n_centre"))
    stars = stars.select(F.col("doc_id").alias("u"), F.col("centre").alias("v"))

    needed = members.select("doc_id").distinct()
    texts = docs.mapInArrow(_pack_batches, "doc_id long, packed binary").join(needed, "doc_id", "left_semi")
    texts = written(texts, "texts")
    links = written(_verified(stars, texts), "links")
    forest = components(links)

    roots = forest.select(F.col("u").alias("__u"), F.col("v").alias("root"))
    placed = members.join(roots, F.col("doc_id") == F.col("__u"), "left").select(
        "key", "doc_id", "n", F.coalesce("root", "doc_id").alias("comp")
    )
    mixed = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
    mixed = written(mixed.select(F.col("key").alias("__k")), "mixed")
    active = placed.join(mixed, F.col("key") == F.col("__k"))
    active = written(active.select(F.col("doc_id").alias("doc"), "n", "comp").distinct(), "active")
    late = _verified(_prefix_pairs(active, texts), texts)
    forest = components(forest.union(late))

    roots = forest.select(F.col("u").alias("__u"), F.col("v").alias("root"))
    named = sets.join(roots, F.col("rep") == F.col("__u"), "left").select(
        F.col("h1").alias("r1"), F.col("h2").alias("r2"), F.coalesce("root", "rep").alias("root")
    )
    named = written(named, "named")
    same = (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")) & (F.col("n") > 0) & F.col("doc_id").isNotNull()
    component = F.coalesce("root", "doc_id")
    return rows.join(named, same, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"),
    )


def without_near_duplicates(df: DataFrame) -> DataFrame:
    """The rows of ``df`` whose document stands for its group (smallest id), columns unchanged."""
    gone = f"{fresh_prefix(df)}removed"
    removed = near_duplicates(df.select("doc_id", "text")).where("not kept").select(F.col("doc_id").alias(gone)).distinct()
    return df.join(removed, F.col("doc_id") == F.col(gone), "left_anti")


# The same rows in DuckDB SQL, from all pairs that share a shingle.
ORACLE_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM words),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b USING (s)
  WHERE a.doc_id != b.doc_id GROUP BY ALL
),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)
),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least_one AS (SELECT x, min(y) AS m FROM reach GROUP BY x)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id,
  w.doc_id = least(w.doc_id, coalesce(m, w.doc_id)) AS kept
FROM words w LEFT JOIN sizes USING (doc_id) LEFT JOIN least_one ON x = w.doc_id
"""
