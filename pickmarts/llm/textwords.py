"""Words of UTF-8 text columns as numpy arrays, a whole Arrow batch at a time.

A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D``, as everywhere in
this subpackage. Words are named by a 64-bit hash of their bytes, so counting,
shingling and matching work on integer arrays. All functions run inside Spark
tasks on one Arrow batch; memory follows the batch, not the table, and texts are
hashed in chunks of ``CHUNK_BYTES`` so that a very long text costs no more
temporary memory than many short ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Separators for words of letters and digits only: every other ASCII byte.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (multiply and xor-shift rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _byte_codes(lower: bool) -> np.ndarray:
    codes = mix64(np.arange(1, 257, dtype=np.uint64))
    if lower:
        codes[65:91] = codes[97:123]
    return codes


_CODES = {flag: _byte_codes(flag) for flag in (False, True)}


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U(base & (2**64 - 1)))
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = {"up": _powers(_BASE, 1 << 12), "down": _powers(_BASE_INV, 1 << 12)}


def _power_table(kind: str, n: int) -> np.ndarray:
    if len(_POW[kind]) < n:
        _POW[kind] = _powers(_BASE if kind == "up" else _BASE_INV, 1 << (n - 1).bit_length())
    return _POW[kind]


@dataclass
class Texts:
    """UTF-8 bytes of a batch: ``data[offsets[i]:offsets[i + 1]]`` is text i (empty for null)."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """The bytes of a string column without copying them where Arrow allows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("")
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    n = len(column)
    _, offs, body = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64, count=n + 1 + column.offset)[column.offset :] if n else np.zeros(1, np.int64)
    whole = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return Texts(whole[offsets[0] : offsets[-1]], offsets - offsets[0])


def texts_from_bytes(parts: list[bytes]) -> Texts:
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return Texts(np.frombuffer(b"".join(parts), dtype=np.uint8), offsets)


def batches_by_bytes(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches into slices of about ``most`` text bytes (at least one row each)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.diff(texts_of(batch.column(batch.schema.get_field_index(column))).offsets)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


@dataclass
class Words:
    """All words of a batch in order: hash, byte span, and the first word index of every text."""

    hash: np.ndarray  # uint64
    start: np.ndarray  # int64 byte position in Texts.data
    end: np.ndarray
    first: np.ndarray  # len(texts) + 1 word offsets

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def _hash_chunk(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> np.ndarray:
    # sum over the word of code[byte] * B^position, then shifted back to the word's start
    # (exact modulo 2^64), by differences of one running sum over the chunk
    n = len(data)
    running = np.empty(n + 1, np.uint64)
    running[0] = 0
    np.cumsum(codes[data] * _power_table("up", n)[:n], out=running[1:])
    h = (running[ends] - running[starts]) * _power_table("down", n + 1)[starts]
    return mix64(h ^ (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def words_of(texts: Texts, lower: bool, separators: np.ndarray = _SPACE) -> Words:
    """Words of every text; ``lower`` folds A-Z before hashing, ``separators`` marks the bytes between words."""
    data, offsets = texts.data, texts.offsets
    n = len(data)
    codes = _CODES[lower]
    hashes, starts, ends = [], [], []
    begin = 0
    while begin < n:
        stop = n
        if n - begin > CHUNK_BYTES:
            # cut at a text border or at white space, so that no word is cut
            border = offsets[np.searchsorted(offsets, begin + CHUNK_BYTES)]
            stop = int(border)
            at = begin + CHUNK_BYTES
            while at < border:
                space = separators[data[at : min(at + 4096, border)]]
                if space.any():
                    stop = at + int(np.argmax(space)) + 1
                    break
                at += 4096
        piece = data[begin:stop]
        space = separators[piece]
        lo, hi = np.searchsorted(offsets, [begin, stop])
        inner = offsets[lo:hi] - begin
        inner = inner[(inner > 0) & (inner < len(piece))]
        word = ~space
        is_start = word.copy()
        is_start[1:] &= space[:-1]
        if len(inner):
            is_start[inner] = word[inner]
        is_end = word.copy()
        is_end[:-1] &= space[1:]
        if len(inner):
            is_end[inner - 1] = word[inner - 1]
        s = np.flatnonzero(is_start)
        e = np.flatnonzero(is_end) + 1
        hashes.append(_hash_chunk(piece, s, e, codes))
        starts.append(s + begin)
        ends.append(e + begin)
        begin = stop
    empty = np.zeros(0, np.int64)
    start = np.concatenate(starts) if starts else empty
    end = np.concatenate(ends) if ends else empty
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return Words(h, start, end, np.searchsorted(start, offsets))


def ngram_hashes(words: Words, n: int, short_whole: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text index and first word index of every run of ``n`` words inside one text.

    With ``short_whole`` a text of 1 to n-1 words counts as one run of all its words.
    """
    counts = words.counts()
    total = len(words.hash)
    if total == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    runs = np.maximum(counts - n + 1, 0)
    doc = np.repeat(np.arange(len(counts)), runs)
    at = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(words.first[:-1], runs)
    h = np.full(len(at), _U(n))
    for k in range(n):
        h = h * _U(0x2545F4914F6CDD1D | 1) + words.hash[at + k]
        h ^= h >> _U(29)
    if short_whole:
        few = np.flatnonzero((counts > 0) & (counts < n))
        if len(few):
            g = counts[few].astype(np.uint64)
            first = words.first[few]
            for k in range(n - 1):
                live = counts[few] > k
                g[live] = g[live] * _U(0x2545F4914F6CDD1D | 1) + words.hash[first[live] + k]
                g[live] ^= g[live] >> _U(29)
            h, doc, at = np.concatenate([h, g]), np.concatenate([doc, few]), np.concatenate([at, first])
            order = np.argsort(doc, kind="stable")
            h, doc, at = h[order], doc[order], at[order]
    return mix64(h), doc, at


def distinct_per_text(h: np.ndarray, doc: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each text, ascending within a text; ``doc`` must ascend."""
    if not len(h):
        return h, doc
    h = h.copy()
    first = np.searchsorted(doc, np.arange(n_texts + 1))
    for a, b in zip(first[:-1], first[1:]):
        h[a:b].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[keep], doc[keep]
