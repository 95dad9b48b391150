"""Operator 12, Merkle manifest of a table as a postorder append log.

Every row is a leaf: the sha256 of its length-prefixed fields. The leaves of a
source, ascending by id, form a tree: every ``ARITY`` consecutive nodes become
the hash of their concatenated digests, the last run of a level may be shorter,
down to one. The tops of the sources, ordered by source, form one more tree.

Nodes are written in the order in which they are complete (postorder), as an
appender would: a node follows its last child. The place of a node in the log of
its tree has a closed form. A node of ``level`` whose last leaf is number ``t``
is preceded by all nodes that end before ``t`` and by its own descendants, so

    place(level, t) = level + sum over k of floor(t / ARITY^k)

(each level k has floor(t / ARITY^k) nodes that end before ``t``; the nodes
that end at ``t`` stand in a row, lowest first.) Siblings are read from the log by
these places; nothing is searched.

Plan: rows are range-sorted by (source, id, leaf) over all tasks and numbered by
the counts of the sorted partitions, so a source of any size spreads. Builders
take aligned blocks of ``BLOCK`` = ARITY^3 leaves, build a block's part of the log
and hand on its root; the roots are the leaves of the next round, until one is left
per source (rounds: logarithm of the largest source to the base 4096). A block's
proof has an inner part, read from its own log, and an outer part that all its
rows share and that comes down from the round above, one row per block. No task
holds more than a block; no digest of a row reaches the driver.

Defined cases: a null field counts as ``-``; a null source is a source of its own,
before all others; null ids come first in their source, their crc32 is that of
the empty text (0, so they are tampered with); rows with equal ids are ordered by
leaf, equal rows are interchangeable; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pickmarts.llm.columns import Scratch, crc_remainder

ARITY = 16
DEPTH = 3
BLOCK = ARITY**DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def place(level: int, last: int) -> int:
    """Place in a tree's log of the node of ``level`` whose last leaf is ``last`` (both from 0)."""
    out = level
    while last:
        out += last
        last //= ARITY
    return out


def height(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    out = 0
    while leaves > 1:
        leaves, out = -(-leaves // ARITY), out + 1
    return out


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def block_log(leaves: list[str], levels: int) -> list[str]:
    """The nodes over ``leaves`` (at most a block) up to ``levels`` in the order they are complete."""
    log: list[str] = []
    open_: list[list[str]] = [[] for _ in range(levels + 1)]

    def append(level: int, digest: str) -> None:
        log.append(digest)
        if level < levels:
            open_[level].append(digest)
            if len(open_[level]) == ARITY:
                close(level)

    def close(level: int) -> None:
        run, open_[level] = open_[level], []
        append(level + 1, _h("".join(run)))

    for leaf in leaves:
        append(0, leaf)
    for level in range(levels):
        if open_[level]:
            close(level)
    return log


def siblings(log: list[str], leaves: int, levels: int, leaf: int) -> list[tuple[str, str]]:
    """For each level the digests left and right of the leaf's path, addressed by their places."""
    out = []
    for level in range(levels):
        width = ARITY**level
        node, count = leaf // width, -(-leaves // width)
        run = range(node // ARITY * ARITY, min(node // ARITY * ARITY + ARITY, count))
        digests = [log[place(level, min((k + 1) * width, leaves) - 1)] for k in run]
        at = node - run.start
        out.append(("".join(digests[:at]), "".join(digests[at + 1 :])))
    return out


def folded(digest: str, path: list[tuple[str, str]]) -> str:
    """The top that follows from a leaf and its siblings."""
    for left, right in path:
        digest = _h(left + digest + right)
    return digest


def leaf_digest(fields: dict[str, Column]) -> Column:
    """sha256 of the fields in their order: ``-`` for null, else the UTF-8 length, a colon and the value."""
    parts = []
    for name in FIELDS:
        value = fields[name].cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _number_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of each row among the rows of its tree in this task; the rows come sorted by tree (column 0)."""
    last, seen = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        tree = batch.column(0).dictionary_encode()
        code = tree.indices.to_numpy()
        fresh = np.ones(len(code), bool)
        fresh[1:] = code[1:] != code[:-1]
        first = np.flatnonzero(fresh)
        local = np.arange(len(code)) - np.repeat(first, np.diff(np.append(first, len(code))))
        begin = batch.column(0)[0].as_py()
        if begin == last:
            local[: first[1] if len(first) > 1 else len(code)] += seen
        last, seen = batch.column(0)[-1].as_py(), int(local[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local)], names=[*batch.schema.names, "local"])


def numbered(rows: DataFrame, order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with ``n`` (rows of the tree) and ``leaf_no`` (from 0, ascending by ``order`` inside the tree).

    Column 0 names the tree. The rows are sorted over all tasks, equal ones
    as they come, so neither a tree nor a repeated row is one task's.
    """
    tree = rows.columns[0]
    keys = [tree, *order, "spread"]
    spread = rows.withColumn("spread", F.monotonically_increasing_id())
    spread = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("spread")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    local = spread.withColumn("task", F.spark_partition_id()).mapInArrow(
        _number_batches, f"{schema}, task int, local long"
    )
    local = scratch.keep(local, name)
    counts = local.groupBy(F.col(tree).alias("of"), F.col("task").alias("in_task")).agg(F.count("*").alias("c"))
    whole = Window.partitionBy("of")  # at most one row a task
    before = whole.orderBy("in_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "of", "in_task", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"), F.sum("c").over(whole).alias("n")
    )
    out = local.join(offsets, (F.col(tree) == F.col("of")) & (F.col("task") == F.col("in_task")))
    return out.select(*rows.columns, "n", (F.col("before") + F.col("local")).alias("leaf_no"))


def _block_rows(group: pa.Table) -> pa.Table:
    """One row: tree, block, n, leaves, levels and log of an aligned block."""
    n = group.column("n")[0].as_py()
    order = np.argsort(group.column("leaf_no").to_numpy())
    digests = group.column("digest").take(pa.array(order)).to_pylist()
    levels = min(height(n), DEPTH)
    log = block_log(digests, levels)
    return pa.table(
        {
            "tree": group.column("tree")[:1],
            "block": group.column("block")[:1],
            "n": pa.array([n], pa.int64()),
            "total": group.column("total")[:1],
            "leaves": pa.array([len(digests)], pa.int32()),
            "levels": pa.array([levels], pa.int32()),
            "log": pa.array([log], pa.list_(pa.string())),
        }
    )


_BLOCK = "tree string, block long, n long, total long, leaves int, levels int, log array<string>"
_PATH = "array<struct<left: string, right: string>>"


def built(leaves: DataFrame, scratch: Scratch, name: str) -> list[DataFrame]:
    """The logs of all trees, a DataFrame per round with one row per aligned block.

    ``leaves``: tree, digest, n (leaves of the tree) and leaf_no. Round r's blocks are the leaves of round r + 1.
    """
    rounds = []
    leaves = leaves.withColumn("total", F.col("n"))
    while True:
        keyed = leaves.select("tree", "digest", "n", "total", "leaf_no", F.expr(f"leaf_no div {BLOCK}").alias("block"))
        log = scratch.keep(keyed.groupBy("tree", "block").applyInArrow(_block_rows, _BLOCK), f"{name}-{len(rounds)}")
        rounds.append(log)
        if (log.agg(F.max("n")).first()[0] or 0) <= BLOCK:
            return rounds
        root, n = F.element_at("log", -1).alias("digest"), F.ceil(F.col("n") / BLOCK).alias("n")
        leaves = log.select("tree", root, n, "total", F.col("block").alias("leaf_no"))


def _tops(rounds: list[DataFrame]) -> DataFrame:
    """(tree, digest): the top of every tree."""
    return rounds[-1].select("tree", F.element_at("log", -1).alias("digest"))


def _child_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path of each leaf of a block: its siblings inside, then the block's own path."""
    for batch in batches:
        for row in batch.to_pylist():
            outer = [(x["left"], x["right"]) for x in row["path"]]
            inner = [siblings(row["log"], row["leaves"], row["levels"], k) for k in range(row["leaves"])]
            paths = [[{"left": x, "right": y} for x, y in p + outer] for p in inner]
            yield pa.RecordBatch.from_pydict(
                {
                    "tree2": [row["tree"]] * len(paths),
                    "block2": [row["block"] * BLOCK + k for k in range(len(paths))],
                    "digest2": [row["log"][place(0, k)] for k in range(len(paths))],
                    "path": paths,
                },
                schema=pa.schema(
                    [("tree2", pa.string()), ("block2", pa.int64()), ("digest2", pa.string()), ("path", _ARROW_PATH)]
                ),
            )


_ARROW_PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _with_paths(rounds: list[DataFrame], top_paths: DataFrame) -> DataFrame:
    """Round 0's blocks with the path from their root to the root of all.

    ``top_paths``: tree2 and path of the trees' tops.
    """
    same = F.col("tree") == F.col("tree2")
    outer = rounds[-1].join(top_paths.select("tree2", "path"), same).drop("tree2")
    for log in reversed(rounds[:-1]):
        below = outer.mapInArrow(_child_batches, f"tree2 string, block2 long, digest2 string, path {_PATH}")
        outer = log.join(below, same & (F.col("block") == F.col("block2"))).drop("tree2", "block2", "digest2")
    return outer


def _proof_maker(root: str):
    def run(key: tuple, rows: pa.Table, blocks: pa.Table) -> pa.Table:
        block = blocks.select(["leaves", "levels", "log", "path", "subroot"]).to_pylist()[0]
        outer = [(x["left"], x["right"]) for x in block["path"]]
        numbers = rows.column("leaf_no").to_numpy() % BLOCK
        proofs, roots = [], []
        shared = "".join(x + y for x, y in outer)
        for leaf, tampered, k in zip(rows.column("digest").to_pylist(), rows.column("tampered").to_pylist(), numbers.tolist()):
            inner = siblings(block["log"], block["leaves"], block["levels"], k)
            proofs.append(_h("".join(x + y for x, y in inner) + shared))
            roots.append(folded(tampered or leaf, inner + outer))
        n = rows.num_rows
        return pa.table(
            {
                "doc_id": rows.column("doc_id"),
                "leaf": rows.column("digest"),
                "subroot": pa.array([block["subroot"]] * n),
                "root": pa.array([root] * n),
                "proof_sha256": pa.array(proofs),
                "folded_root": pa.array(roots),
                "verified": pa.array([r == root for r in roots]),
            }
        )

    return run


def _leaves(df: DataFrame) -> DataFrame:
    fields = {c: F.col(c) for c in FIELDS}
    changed = fields | {"text": F.translate("text", _UPPER, _LOWER)}
    tampered = F.when(crc_remainder(F.col("doc_id"), TAMPER) == 0, leaf_digest(changed))
    # a key without nulls that sorts as the source does, null first
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    return df.select(tree.alias("tree"), "doc_id", leaf_digest(fields).alias("digest"), tampered.alias("tampered"))


def manifest_log(df: DataFrame) -> DataFrame:
    """source, place, level and digest of every node over the rows of each source, as appended."""
    scratch = Scratch(df.sparkSession, "merkle-log")
    leaves = scratch.keep(numbered(_leaves(df).select("tree", "doc_id", "digest"), ["doc_id", "digest"], scratch, "rows"), "leaves")
    out = None
    for r, log in enumerate(built(leaves, scratch, "log")):
        rows = log.mapInArrow(_node_batches(r), "tree string, place long, level int, digest string")
        out = rows if out is None else out.union(rows)
    return out.select(F.expr("if(tree = '', null, substr(tree, 2))").alias("source"), "place", "level", "digest")


def _node_batches(round_: int):
    """The nodes of a round's blocks; a later round leaves out its leaves, which the round before has written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places, levels, digests = [], [], []
                unit, m = BLOCK**round_, row["leaves"]
                for level in range(1 if round_ else 0, row["levels"] + 1):
                    width = ARITY**level
                    for k in range(-(-m // width)):
                        last = min((k + 1) * width, m) - 1
                        # level and last leaf in the whole tree
                        end = (row["block"] * BLOCK + last + 1) * unit
                        places.append(place(level + DEPTH * round_, min(end, row["total"]) - 1))
                        levels.append(level + DEPTH * round_)
                        digests.append(row["log"][place(level, last)])
                yield pa.RecordBatch.from_pydict(
                    {"tree": [row["tree"]] * len(places), "place": places, "level": levels, "digest": digests},
                    schema=pa.schema([("tree", pa.string()), ("place", pa.int64()), ("level", pa.int32()), ("digest", pa.string())]),
                )

    return run


def op12_manifest(df: DataFrame) -> DataFrame:
    """The contract's columns for a documents table."""
    spark = df.sparkSession
    scratch = Scratch(spark, "merkle")
    leaves = scratch.keep(numbered(_leaves(df), ["doc_id", "digest"], scratch, "rows"), "leaves")
    scratch.drop("rows")
    rounds = built(leaves, scratch, "log")
    # the tops of the sources are the leaves of one more tree
    tops = _tops(rounds).select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), "digest")
    tops = scratch.keep(numbered(tops, ["source_tree"], scratch, "tops"), "top-leaves")
    upper = built(tops, scratch, "top-log")
    root = upper[-1].select(F.element_at("log", -1)).first()
    none = spark.createDataFrame([("", [])], f"tree2 string, path {_PATH}")
    children = _with_paths(upper, none).mapInArrow(_child_batches, f"tree2 string, block2 long, digest2 string, path {_PATH}")
    top_paths = tops.select("source_tree", "leaf_no").join(children, F.col("leaf_no") == F.col("block2"))
    top_paths = scratch.keep(top_paths.select(F.col("source_tree").alias("tree2"), "path", F.col("digest2").alias("subroot")), "paths")
    blocks = _with_paths(rounds, top_paths).join(top_paths.select("tree2", "subroot"), F.col("tree") == F.col("tree2"))
    blocks = blocks.select("tree", "block", "leaves", "levels", "log", "path", "subroot")
    rows = leaves.withColumn("block", F.expr(f"leaf_no div {BLOCK}"))
    kind = df.schema["doc_id"].dataType.simpleString()
    return rows.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(
        _proof_maker(root[0] if root else ""),
        f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean",
    )


def _oracle_sql(source_levels: int = 5, top_levels: int = 3) -> str:
    """The same rows in DuckDB SQL: trees of up to ARITY^levels leaves, level by level; t is the tampered path."""

    def field(name: str, value: str) -> str:
        return f"coalesce(octet_length(encode({value}))::VARCHAR || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        values = {c: f"{c}::VARCHAR" for c in FIELDS} | {"text": text}
        return "sha256(" + " || ".join(field(c, v) for c, v in values.items()) + ")"

    def levels(table: str, n: int) -> str:
        out = ""
        for k in range(n):
            out += f"""
{table}{k + 1} AS MATERIALIZED (
  SELECT tree, i // {ARITY} AS i, CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d,
    CASE WHEN any_value(n) = 1 THEN 1 ELSE (any_value(n) + {ARITY - 1}) // {ARITY} END AS n
  FROM {table}{k} GROUP BY tree, i // {ARITY}),"""
        return out

    def path(table: str, leaves: str, n: int, digest: str, out: str) -> str:
        sql, last = "", leaves
        for k in range(n):
            sides = [
                f"coalesce((SELECT string_agg(s.d, '' ORDER BY s.i) FROM {table}{k} s WHERE s.tree = p.tree AND s.i // {ARITY} = p.i // {ARITY} AND s.i {c} p.i), '')"
                for c in "<>"
            ]
            sql += f"""
{out}{k + 1} AS MATERIALIZED (
  SELECT id, tree, i // {ARITY} AS i, proof || x || y AS proof, CASE WHEN x = '' AND y = '' AND m = 1 THEN {digest} ELSE sha256(x || {digest} || y) END AS {digest}
  FROM (SELECT p.*, q.n AS m, {sides[0]} AS x, {sides[1]} AS y FROM {last} p JOIN {table}{k} q ON q.tree = p.tree AND q.i = p.i)),"""
            last = f"{out}{k + 1}"
        return sql

    low = f"translate(text, '{_UPPER}', '{_LOWER}')"
    crc = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(doc_id::VARCHAR)), lambda k: ord(substr(doc_id::VARCHAR, k + 1, 1))::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
    return f"""
WITH leaves AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, coalesce('s' || source, '') AS tree, {leaf("text")} AS d,
    CASE WHEN xor({crc}, 4294967295) % {TAMPER} = 0 THEN {leaf(low)} ELSE {leaf("text")} END AS t FROM documents),
a0 AS MATERIALIZED (
  SELECT id, doc_id, tree, d, t, row_number() OVER (PARTITION BY tree ORDER BY doc_id, d) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
{levels("a", source_levels)}
b0 AS MATERIALIZED (SELECT '' AS tree, tree AS source_tree, row_number() OVER (ORDER BY tree) - 1 AS i, d, count(*) OVER () AS n FROM a{source_levels}),
{levels("b", top_levels)}
p0 AS (SELECT id, tree, i, t, '' AS proof FROM a0),
{path("a", "p0", source_levels, "t", "p")}
q0 AS (SELECT id, '' AS tree, b0.i, t, proof FROM p{source_levels} p JOIN b0 ON b0.source_tree = p.tree),
{path("b", "q0", top_levels, "t", "q")}
whole AS (SELECT d AS root FROM b{top_levels})
SELECT doc_id, leaves.d AS leaf, b0.d AS subroot, root, sha256(proof) AS proof_sha256, q.t AS folded_root, q.t = root AS verified
FROM leaves JOIN q{top_levels} q USING (id) JOIN b0 ON b0.source_tree = leaves.tree CROSS JOIN whole
"""


ORACLE_SQL = _oracle_sql()
