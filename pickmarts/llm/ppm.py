"""Operator 9, LM scoring by prediction by partial matching (PPM) over bytes.

A text is its words (A-Z folded), each closed by a space, then an end mark. The
model predicts every byte from the up to ``ORDER`` bytes before it, as far back as
the space before its word; a word's first byte and the end mark see one byte
more, the last of the word before, so that a text's score depends on the order of its
words. Its trie holds, for every such context of the training texts, how often each byte followed. A byte not seen
after the longest known context escapes to the next shorter one: with T
occurrences and D distinct bytes in a context the escape has probability
D / 2T and a byte seen c times (2c - 1) / 2T (method D). Bytes of the longer
context are excluded from the shorter one, as they would not have escaped; below
the empty context all remaining symbols are equally likely. The tries are
pretrained, so a word's code length depends on the word and the byte before its
space alone, and a document's is a sum over its words and the borders between them.

Texts of different kinds (languages) get a trie each: ``label`` names the kind of
the training texts, the ``KINDS`` - 1 most frequent labels have their own trie and
all others share one. A document's probability is the mixture of the tries,
weighted by their training texts; its own label is never used.

How Spark does it:
1. Words and their training counts: distinct words per task, then one
   aggregation. N and V, the tries' counts and the unigram base all come from
   this vocabulary, which grows with the corpus. The same pass counts the borders
   (last byte of a word, first byte of the next): at most 256 * 257 of them.
2. The tries are counted by one aggregation of (kind, context, byte) keys and stay
   a table, whole whatever their size. A byte's code length depends on the at most
   ``ORDER`` bytes before it and itself: such a place is a slot. Nodes and slots
   are dealt by the last two bytes of their context and the third last, so a slot meets all its
   contexts of three bytes and more in one group; nodes of two bytes go to each of the
   ``SPLIT`` parts their third byte may lead to, the shorter contexts (at most
   256 * 257 + 257 nodes a kind) are sent along. No task holds a trie, and the groups
   grow in number with the nodes. Each distinct slot is scored once, and a word's code
   lengths come by a join on its slots.
3. The most frequent words, ``COMMON`` at most, are scored inside the document
   pass from a table of bounded size, and so are the borders: a table of what the byte
   before the space adds to the code length of the byte after it. Any other word makes up less than about
   1 / ``COMMON`` of all, so it can't be a hot key. It meets its entry in the
   scored vocabulary by a join, and the sums come back by document.

Intermediate tables are deleted after their last reader, but for the two that the result reads.

Defined cases: null or blank text is its end mark alone; a null id counts as the
empty text for the held-out rule; null labels are a label; repeated rows each get
the score of their text; without training texts all counts are 0 and bytes are
equally likely; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickmarts.llm.columns import Scratch, crc_remainder
from pickmarts.llm.textwords import Texts, Words, batches_by_bytes, texts_from_bytes, texts_of, words_of

ORDER = 5
KINDS = 8
COMMON = 1 << 18
SYMBOLS = 257  # bytes and the end mark
END = 256
SPACE = 0x20
SMOOTH = 0.1
# nodes and slots are dealt to groups by the last three bytes of their context, of the third only its
# remainder by SPLIT counts; a group for each GROUP_NODES nodes, GROUPS at least
GROUPS = 1024
GROUP_NODES = 1 << 15
SPLIT = 8
# borders: the last byte of a word and what follows its space
CELLS = 256 * SYMBOLS
# distinct words and trie nodes a task holds before it hands them on
TASK_WORDS = 250_000
TASK_NODES = 400_000

_I = np.int64


def _stream(words: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every symbol of every word with its closing space: symbol, word index, position in the word."""
    sizes = np.diff(words.offsets)
    word = np.repeat(np.arange(len(sizes)), sizes + 1)
    place = np.arange(len(word)) - np.repeat(np.cumsum(sizes + 1) - sizes - 1, sizes + 1)
    last = place == sizes[word]
    data = np.append(words.data, np.uint8(SPACE))
    symbol = np.where(last, SPACE, data[np.where(last, 0, words.offsets[:-1][word] + place)]).astype(_I)
    return symbol, word, place


def _longest_context(symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The ``ORDER`` bytes before each symbol as one number (only place + 1 of them count)."""
    key = np.zeros(len(symbol), _I)
    for back in range(ORDER, 0, -1):
        before = np.full(len(symbol), SPACE, _I)
        before[back:] = symbol[:-back]
        # the byte just before a word's first byte is the space
        key = key << 8 | np.where(place >= back, before, SPACE)
    return key


def _context(longest: np.ndarray, order: int) -> np.ndarray:
    """The last ``order`` bytes, with their number above them."""
    return longest & ((1 << (8 * order)) - 1) | order << (8 * order)


def _length(context: np.ndarray) -> np.ndarray:
    """The number of bytes of a context."""
    length = context.copy()
    for k in range(ORDER, -1, -1):
        length = np.where((context >> (8 * k) == k), k, length)
    return length


def _node(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return context << 9 | symbol


#: The slot of the end mark, which follows the space, and the first node of a context of two bytes.
END_SLOT = (1 << 8 | SPACE) << 9 | END
TWO_BYTES = 2 << 16 << 9
THREE_BYTES = 3 << 24 << 9


def slots_of(words: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Every symbol of every word as the node of its longest context, and its word."""
    symbol, word, place = _stream(words)
    longest = _longest_context(symbol, place)
    order = np.minimum(place + 1, ORDER)
    return _node(longest & ((1 << (8 * order)) - 1) | order << (8 * order), symbol), word


def count_nodes(words: Texts, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trie nodes (context and following symbol) of counted words, with their counts."""
    symbol, word, place = _stream(words)
    longest = _longest_context(symbol, place)
    keys, times = [], []
    for order in range(ORDER + 1):
        ok = place + 1 >= order
        one, where = np.unique(_node(_context(longest[ok], order), symbol[ok]), return_inverse=True)
        keys.append(one)
        times.append(np.bincount(where, weights=counts[word[ok]], minlength=len(one)).astype(_I))
    return np.concatenate(keys), np.concatenate(times)


_FOLD = np.arange(256)
_FOLD[65:91] += 32


def borders(texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Every space after a word as its border (last byte before it, symbol after it), and its text."""
    counts = words.counts()
    some = np.flatnonzero(counts)
    first = np.zeros(len(words.hash), bool)
    first[words.first[:-1][some]] = True
    inner = np.flatnonzero(~first)
    last = words.first[1:][some] - 1
    before = _FOLD[texts.data[words.end[np.concatenate([inner - 1, last])] - 1]]
    after = np.concatenate([_FOLD[texts.data[words.start[inner]]], np.full(len(some), END)])
    return before * SYMBOLS + after, np.concatenate([words.doc()[inner], some])


def border_gains(low: list[tuple[np.ndarray, np.ndarray]], counts: np.ndarray) -> np.ndarray:
    """What the byte before a space adds to the log10 probability of the symbol after it, by kind and border.

    ``low``: each kind's nodes below two bytes; ``counts``: each kind's uses of every border.
    """
    cell = np.arange(CELLS)
    node = _node(2 << 16 | cell // SYMBOLS << 8 | SPACE, cell % SYMBOLS)
    plain = _node(np.full(SYMBOLS, 1 << 8 | SPACE), np.arange(SYMBOLS))
    gains = []
    for (short, times), uses in zip(low, counts):
        seen = uses > 0
        trie = Trie.of(np.concatenate([short, node[seen]]), np.concatenate([times, uses[seen]]))
        gains.append(trie.code(node) - trie.code(plain)[cell % SYMBOLS])
    return np.stack(gains)


def end_nodes(n_texts: int) -> dict[int, int]:
    """The nodes of the end mark: it follows the space like a word's first byte."""
    return {int(_node(np.array([c]), np.array([END]))[0]): n_texts for c in (0, 1 << 8 | SPACE)} if n_texts else {}


@dataclass
class Trie:
    """Counts of a PPM model as sorted arrays.

    ``node``/``count``: context and symbol. ``context``: with its total, its
    distinct symbols, and what its escape leaves of the next shorter context
    (total and distinct symbols without those seen here).
    """

    node: np.ndarray
    count: np.ndarray
    context: np.ndarray
    total: np.ndarray
    distinct: np.ndarray
    left_total: np.ndarray
    left_distinct: np.ndarray

    @classmethod
    def of(cls, node: np.ndarray, count: np.ndarray) -> Trie:
        order = np.argsort(node)
        node, count = node[order], count[order].astype(np.float64)
        own = node >> 9
        context, where = np.unique(own, return_inverse=True)
        total = np.bincount(where, weights=count, minlength=len(context))
        distinct = np.bincount(where, minlength=len(context)).astype(np.float64)
        # the same symbol one context shorter: drop the oldest byte
        length = _length(own)
        shorter = np.where(length > 0, (length - 1) << (8 * np.maximum(length - 1, 0)) | own & ((1 << (8 * np.maximum(length - 1, 0))) - 1), -1)
        at = np.minimum(np.searchsorted(node, _node(np.maximum(shorter, 0), node & 511)), max(len(node) - 1, 0))
        seen = np.where((length > 0), count[at] if len(node) else 0.0, 0.0)
        excluded = np.bincount(where, weights=seen, minlength=len(context))
        parent = np.full(len(context), -1, _I)
        parent[where] = shorter
        up = np.minimum(np.searchsorted(context, np.maximum(parent, 0)), max(len(context) - 1, 0))
        has = parent >= 0
        left_total = np.where(has, total[up] - excluded, 0.0) if len(context) else total
        left_distinct = np.where(has, distinct[up] - distinct, 0.0) if len(context) else distinct
        return cls(node, count, context, total, distinct, left_total, left_distinct)

    def _find(self, keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(keys), _I), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return at, table[at] == keys

    def code(self, slots: np.ndarray) -> np.ndarray:
        """log10 probability of every slot's symbol given the bytes before it."""
        n = len(slots)
        symbol, longest = slots & 511, slots >> 9
        orders = _length(longest)
        out = np.zeros(n)
        open_ = np.arange(n)
        total, distinct = np.zeros(n), np.zeros(n)
        entered = np.zeros(n, bool)
        for order in range(ORDER, -1, -1):
            use = open_[orders[open_] >= order]
            context = _context(longest[use], order)
            at, known = self._find(context, self.context)
            use, at, context = use[known], at[known], context[known]
            if not len(use):
                continue
            t = np.where(entered[use], total[use], self.total[at])
            d = np.where(entered[use], distinct[use], self.distinct[at])
            some = d > 0  # a context with nothing new is passed over
            node, hit = self._find(_node(context, symbol[use]), self.node)
            hit &= some
            odds = np.where(hit, 2 * self.count[node] - 1, d)
            out[use] += np.where(some, np.log10(np.where(some, odds, 1.0) / np.where(some, 2 * t, 1.0)), 0.0)
            entered[use] = True
            total[use], distinct[use] = self.left_total[at], self.left_distinct[at]
            live = np.ones(n, bool)
            live[use[hit]] = False
            open_ = open_[live[open_]]
        seen = self.distinct[0] if len(self.context) and self.context[0] == 0 else 0.0
        out[open_] -= np.log10(max(SYMBOLS - seen, 1.0))
        return out


def _word_bytes(texts: Texts, start: np.ndarray, end: np.ndarray) -> list[bytes]:
    data = texts.data.tobytes()
    return [data[a:b].lower() for a, b in zip(start.tolist(), end.tolist())]


def _vocabulary_batches(kinds: int):
    """(word, uses, learned_0 ...): distinct words of many texts, with uses in all and in the training texts by kind.

    The borders of the training texts come as words that begin with a space, which no word does.
    """
    names = ["word", "uses", *[f"learned_{k}" for k in range(kinds)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[bytes, int] = {}
        table = np.zeros((1024, kinds + 1), _I)
        met = np.zeros(kinds * CELLS, _I)

        def handed() -> pa.RecordBatch:
            part = table[: len(place)]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(place), pa.binary()), *[pa.array(part[:, k]) for k in range(kinds + 1)]], names=names
            )

        for batch in batches_by_bytes(batches, "text"):
            texts = texts_of(batch.column(0))
            kind = batch.column(1).to_numpy()  # -1: not a training text
            words = words_of(texts, lower=True)
            one, at, where = np.unique(words.hash, return_index=True, return_inverse=True)
            cell, of = borders(texts, words)
            taught = kind[of] >= 0
            met += np.bincount(kind[of[taught]] * CELLS + cell[taught], minlength=kinds * CELLS)
            own = kind[words.doc()]
            uses = np.zeros((len(one), kinds + 1), _I)
            uses[:, 0] = np.bincount(where, minlength=len(one))
            cells = np.bincount((where * (kinds + 1) + own + 1)[own >= 0], minlength=len(one) * (kinds + 1))
            uses[:, 1:] = cells.reshape(-1, kinds + 1)[:, 1:]
            rows = [place.setdefault(w, len(place)) for w in _word_bytes(texts, words.start[at], words.end[at])]
            if len(place) > len(table):
                table = np.concatenate([table, np.zeros((2 * len(place) - len(table), kinds + 1), _I)])
            table[rows] += uses
            if len(place) > TASK_WORDS:
                yield handed()
                place.clear()
                table[:] = 0
        yield handed()
        seen = np.flatnonzero(met.reshape(kinds, CELLS).any(axis=0))
        names_of = [b" " + int(c).to_bytes(3, "big") for c in seen]
        uses = [pa.array(met[k * CELLS + seen]) for k in range(kinds)]
        yield pa.RecordBatch.from_arrays([pa.array(names_of, pa.binary()), pa.array(np.zeros(len(seen), _I)), *uses], names=names)

    return run


def _node_batches(kinds: int):
    """(kind, node, uses) of a part of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0, _I), np.zeros(0, _I))] * kinds

        def handed() -> Iterator[pa.RecordBatch]:
            for kind, (keys, times) in enumerate(held):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(times)],
                    names=["kind", "node", "uses"],
                )

        for batch in batches:
            words = batch.column(0).to_pylist()
            for kind in range(kinds):
                counts = batch.column(kind + 1).to_numpy()
                live = np.flatnonzero(counts)
                if len(live):
                    k, t = count_nodes(texts_from_bytes([words[i] for i in live]), counts[live])
                    keys, where = np.unique(np.concatenate([held[kind][0], k]), return_inverse=True)
                    weights = np.concatenate([held[kind][1], t])
                    held[kind] = keys, np.bincount(where, weights=weights, minlength=len(keys)).astype(_I)
            if sum(len(k) for k, _ in held) > TASK_NODES:
                yield from handed()
                held = [(np.zeros(0, _I), np.zeros(0, _I))] * kinds
        yield from handed()

    return run


def _slot_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot): the distinct slots of a part of the vocabulary."""
    held = np.zeros(0, _I)
    for batch in batches:
        held = np.union1d(held, slots_of(texts_from_bytes(batch.column(0).to_pylist()))[0])
        if len(held) > TASK_NODES:
            yield pa.RecordBatch.from_arrays([pa.array(held)], names=["slot"])
            held = held[:0]
    yield pa.RecordBatch.from_arrays([pa.array(held)], names=["slot"])


def _spelled_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, slot): a row for every symbol of every vocabulary entry."""
    for batch in batches:
        if batch.num_rows:
            words = texts_from_bytes(batch.column(0).to_pylist())
            slot, word = slots_of(words)
            own = words_of(words, lower=True).hash.view(_I)  # every entry is one word
            yield pa.RecordBatch.from_arrays([pa.array(own[word]), pa.array(slot)], names=["hash", "slot"])


def _hashed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, learned, uses) of every vocabulary entry."""
    for batch in batches:
        if batch.num_rows:
            words = words_of(texts_from_bytes(batch.column(0).to_pylist()), lower=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.hash.view(_I)), *batch.columns[1:]], names=["hash", "learned", "uses"]
            )


def _coded(low: list[tuple[np.ndarray, np.ndarray]]):
    """(slot, code_0 ...) of a group of nodes (kind, node, uses) and slots (kind -1); ``low``: each kind's short contexts."""

    def run(group: pa.Table) -> pa.Table:
        kind, node, uses = (group.column(c).to_numpy() for c in ("kind", "node", "uses"))
        slots = np.unique(node[kind < 0])
        last = np.unique(slots >> 9 & 255)
        codes = []
        for k, (short, times) in enumerate(low):
            near = (short >> 17 == 0) | np.isin(short >> 9 & 255, last)
            # nodes of two bytes come once for every part that is dealt to this group
            own = np.flatnonzero(kind == k)
            own = own[np.unique(node[own], return_index=True)[1]]
            trie = Trie.of(np.concatenate([short[near], node[own]]), np.concatenate([times[near], uses[own]]))
            codes.append(trie.code(slots).astype(np.float32))
        return pa.table([pa.array(slots), *map(pa.array, codes)], names=["slot", *_codes(len(low))])

    return run


def _codes(kinds: int) -> list[str]:
    return [f"code_{k}" for k in range(kinds)]


def _sums(kinds: int) -> list[str]:
    return ["base", *[f"score_{k}" for k in range(kinds)]]


@dataclass
class CommonWords:
    """The scored entries of the most frequent words, sorted by hash; ``values``: known, base and scores."""

    hash: np.ndarray
    values: np.ndarray

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.hash):
            return np.zeros(len(h), _I), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        return at, self.hash[at] == h


def _local_batches(common: CommonWords, gains: np.ndarray, names: list[str]):
    """(row, doc_id, n_words, known, base, scores): what the common words and the borders of each text add up to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_bytes(batches, "text"):
            texts = texts_of(batch.column(0))
            words = words_of(texts, lower=True)
            n = batch.num_rows
            at, hit = common.find(words.hash)
            doc, at = words.doc()[hit], at[hit]
            sums = [np.bincount(doc, weights=common.values[at, k], minlength=n) for k in range(common.values.shape[1])]
            cell, of = borders(texts, words)
            for k, gain in enumerate(gains):
                sums[2 + k] += np.bincount(of, weights=gain[cell], minlength=n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(words.counts()), pa.array(sums[0].astype(_I)), *map(pa.array, sums[1:])],
                names=names,
            )

    return run


def _rare_batches(common: CommonWords):
    """(row, hash, uses): the other words of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_bytes(batches, "text"):
            words = words_of(texts_of(batch.column(0)), lower=True)
            _, hit = common.find(words.hash)
            doc, h = words.doc()[~hit], words.hash[~hit]
            order = np.lexsort((h, doc))
            doc, h = doc[order], h[order]
            fresh = np.ones(len(h), bool)
            fresh[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            start = np.flatnonzero(fresh)
            uses = np.diff(np.append(start, len(h)))
            rows = batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[doc[start]]), pa.array(h[start].view(_I)), pa.array(uses)], names=["row", "hash", "uses"]
            )

    return run


def _kinds(df: DataFrame, learn: Column, label: Column | None) -> tuple[Column, list[int]]:
    """The kind number of a row by its label (-1: not learned from), and the training texts of each kind."""
    if label is None:
        label = F.lit("")
    label = F.coalesce(label.cast("string"), F.lit(""))
    counts = df.where(learn).groupBy(label.alias("label")).count().orderBy(F.desc("count"), "label")
    top = counts.limit(KINDS - 1).collect()
    n = df.where(learn).count()
    sizes = [r[1] for r in top]
    rest = n - sum(sizes)
    kind = F.lit(len(top))
    for k, r in enumerate(top):
        kind = F.when(label == r[0], k).otherwise(kind)
    return F.when(learn, kind).otherwise(-1), [*sizes, *([rest] if rest else [])] or [0]


def short_nodes(nodes: DataFrame, texts_of_kind: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each kind's nodes below two bytes, end marks included, with their counts."""
    short = nodes.where(F.col("node") < TWO_BYTES).toArrow()  # at most 256 * 257 + 257 nodes a kind
    kind, node, uses = (short.column(c).to_numpy() for c in ("kind", "node", "uses"))
    low = []
    for k, n in enumerate(texts_of_kind):
        ends = end_nodes(n)
        low.append(
            (
                np.concatenate([node[kind == k], np.array(list(ends), _I)]),
                np.concatenate([uses[kind == k], np.array(list(ends.values()), _I)]),
            )
        )
    return low


def slot_codes(nodes: DataFrame, slots: DataFrame, low: list[tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(slot, code_0 ...): log10 probability of every slot under the trie of every kind.

    Kept in single precision (a part in 10^7), the largest table of all; sums are double.
    """
    end = nodes.sparkSession.range(1).select(F.lit(END_SLOT).cast("long").alias("slot"))
    asked = slots.union(end).distinct().select(
        F.lit(-1).alias("kind"), F.col("slot").alias("node"), F.lit(0).cast("long").alias("uses")
    )
    both = nodes.where(F.col("node") >= TWO_BYTES).select("kind", "node", "uses").union(asked)
    third = F.shiftright("node", 9 + 16).bitwiseAND(F.lit(SPLIT - 1))
    every = F.array(*[F.lit(k).cast("long") for k in range(SPLIT)])
    parts = F.when(F.col("node") >= THREE_BYTES, F.array(third)).when(F.col("kind") >= 0, every)
    both = both.select("kind", "node", "uses", F.explode(F.coalesce(parts, F.array(F.lit(0).cast("long")))).alias("part"))
    groups = max(GROUPS, nodes.count() // GROUP_NODES)
    group = F.pmod(F.xxhash64(F.shiftright("node", 9).bitwiseAND(F.lit(0xFFFF)), "part"), F.lit(groups))
    both = both.select("kind", "node", "uses", group.alias("tail"))
    schema = "slot long, " + ", ".join(f"{c} float" for c in _codes(len(low)))
    return both.groupBy("tail").applyInArrow(_coded(low), schema)


def _least_uses(vocabulary: DataFrame, most: int) -> float:
    """The smallest use count that at most ``most`` words reach, to a quarter of a power of two."""
    octave = F.floor(F.log2(F.col("uses")) * 4)
    found = vocabulary.groupBy(octave.alias("octave")).count().collect()  # at most 4 * 63 rows
    kept, least = 0, float("inf")
    for octave, words in sorted(((r[0], r[1]) for r in found), reverse=True):
        kept += words
        if kept > most:
            break
        least = octave
    return least


def score(df: DataFrame, learn: Column, label: Column | None = None) -> tuple[DataFrame, dict]:
    """Scores of all rows of ``df`` (doc_id, text) under a model of the rows where ``learn`` holds.

    Returns doc_id, n_words, known, base (sum of log10(c + 0.1) over the words) and
    score (log10 probability of the text), and the model's constants.
    """
    kind, texts_of_kind = _kinds(df, learn, label)
    kinds, n_texts = len(texts_of_kind), sum(texts_of_kind)
    texts = df.select(F.coalesce("text", F.lit("")).alias("text"), kind.cast("int").alias("kind"), "doc_id")
    learned_by = [f"learned_{k}" for k in range(kinds)]
    schema = "word binary, uses long, " + ", ".join(f"{c} long" for c in learned_by)
    found = texts.select("text", "kind").mapInArrow(_vocabulary_batches(kinds), schema)
    vocabulary = found.groupBy("word").agg(*[F.sum(c).alias(c) for c in ["uses", *learned_by]])
    learned = sum((F.col(c) for c in learned_by[1:]), F.col(learned_by[0]))
    scratch = Scratch(df.sparkSession, "ppm")
    counted = scratch.keep(vocabulary.withColumn("learned", learned), "words")
    border = F.expr("substring(word, 1, 1) = X'20'")
    vocabulary = counted.where(~border)
    met = counted.where(border).select("word", *learned_by).toArrow()  # at most 256 * 257 rows
    cells = np.array([int.from_bytes(w[1:], "big") for w in met.column(0).to_pylist()], _I)
    crossed = np.zeros((kinds, CELLS), _I)
    for k in range(kinds):
        crossed[k, cells] = met.column(k + 1).to_numpy()
    size = vocabulary.agg(F.sum("learned"), F.count_if(F.col("learned") > 0)).first()
    total = (size[0] or 0) + n_texts
    distinct = (size[1] or 0) + (1 if n_texts else 0)

    counted = vocabulary.where("learned > 0").select("word", *learned_by)
    nodes = counted.mapInArrow(_node_batches(kinds), "kind int, node long, uses long")
    nodes = scratch.keep(nodes.groupBy("kind", "node").agg(F.sum("uses").alias("uses")), "trie")
    slots = vocabulary.select("word").mapInArrow(_slot_batches, "slot long")
    low = short_nodes(nodes, texts_of_kind)
    gains = border_gains(low, crossed)
    codes = scratch.keep(slot_codes(nodes, slots, low), "codes")
    scratch.drop("trie")
    ends = list(codes.where(F.col("slot") == END_SLOT).first())[1:]

    sums = _sums(kinds)
    doubles = ", ".join(f"{c} double" for c in sums)
    spelled = vocabulary.select("word").mapInArrow(_spelled_batches, "hash long, slot long")
    # counts meet the sums afterwards, once a word instead of once a symbol
    words = vocabulary.select("word", "learned", "uses").mapInArrow(_hashed_batches, "hash long, learned long, uses long")
    summed = [F.sum(c).alias(s) for c, s in zip(_codes(kinds), sums[1:])]
    entries = spelled.join(codes, "slot").groupBy("hash").agg(*summed).join(words, "hash")
    often = F.floor(F.log2("uses") * 4) >= F.lit(float(_least_uses(vocabulary, COMMON)))
    entries = scratch.keep(
        entries.select(
            "hash",
            (F.col("learned") > 0).cast("long").alias("known"),
            F.log10(F.col("learned") + F.lit(SMOOTH)).alias("base"),
            *sums[1:],
            "uses",
        ),
        "entries",
    )
    scratch.drop("words", "codes")
    top = entries.where(often).drop("uses").toArrow()
    order = np.argsort(top.column(0).to_numpy().view(np.uint64))
    values = [top.column(k + 1).to_numpy()[order].astype(float) for k in range(kinds + 2)]
    common = CommonWords(top.column(0).to_numpy().view(np.uint64)[order], np.stack(values, axis=1))

    # rows are named by id and text: equal rows share a name and have equal sums
    named = texts.select("text", F.xxhash64("doc_id", "text").alias("row"), "doc_id")
    names = ["row", "doc_id", "n_words", "known", *sums]
    kind_of_id = df.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind_of_id}, n_words long, known long, {doubles}"
    local = scratch.keep(named.mapInArrow(_local_batches(common, gains, names), schema), "local")
    rare = named.select("text", "row").mapInArrow(_rare_batches(common), "row long, hash long, uses long")
    scored = entries.where(~often).drop("uses")
    met = rare.join(scored, "hash")
    back = met.groupBy("row").agg(*[F.sum(F.col("uses") * F.col(c)).alias(f"{c}_rare") for c in ["known", *sums]])
    times = local.groupBy("row").agg(F.count("*").alias("times")).where("times > 1")
    back = back.join(times.select(F.col("row").alias("again"), "times"), F.col("row") == F.col("again"), "left")
    share = F.coalesce("times", F.lit(1))
    back = back.select(
        F.col("row").alias("of_row"),
        (F.col("known_rare") / share).cast("long").alias("known_rare"),
        *[(F.col(f"{c}_rare") / share).alias(f"{c}_rare") for c in sums],
    )
    both = local.join(back, F.col("row") == F.col("of_row"), "left")
    whole = {c: F.col(c) + F.coalesce(F.col(f"{c}_rare"), F.lit(0.0)) for c in sums}
    # the mixture of the kinds, by their share of the training texts
    prior = [float(np.log10(n / n_texts)) if n else 0.0 for n in texts_of_kind]
    each = [whole[f"score_{k}"] + (prior[k] + ends[k]) for k in range(kinds)]
    best = F.greatest(*each) if kinds > 1 else each[0]
    mixed = best + F.log10(sum((F.pow(F.lit(10.0), x - best) for x in each), F.lit(0.0)))
    out = both.select(
        "doc_id",
        "n_words",
        (F.col("known") + F.coalesce("known_rare", F.lit(0))).alias("known"),
        whole["base"].alias("base"),
        mixed.alias("score"),
    )
    return out, {"tokens": total, "distinct": distinct, "texts": n_texts}


def op9_score(df: DataFrame) -> DataFrame:
    """The contract's columns for a documents table."""
    held_out = crc_remainder(F.col("doc_id"), 10) == 0
    sums, model = score(df.select("doc_id", "text", "lang"), ~held_out, F.col("lang"))
    norm = float(np.log10(model["tokens"] + SMOOTH * (model["distinct"] + 1)))
    n_tokens = F.col("n_words") + 1
    return sums.select(
        "doc_id",
        held_out.alias("held_out"),
        n_tokens.alias("n_tokens"),
        (F.col("known") + F.lit(1 if model["texts"] else 0)).alias("n_known"),
        F.lit(int(model["tokens"])).cast("long").alias("train_tokens"),
        (F.col("base") + float(np.log10(model["texts"] + SMOOTH)) - n_tokens * norm).alias("base_score"),
        "score",
    )
