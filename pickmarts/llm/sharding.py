"""Operator 1, sharding: a hierarchical weighted hash tree.

Shards hang in racks and racks in regions. A row descends the tree: at every
node each child draws ``-ln(u) / weight`` with ``u`` hashed from the child's name
and the row's key, and the smallest draw wins, so a child gets rows in proportion
to its weight (the sum of the shard weights below it). A draw depends on nothing
but the child, its weight and the key. A changed weight therefore changes only
the draws of the nodes above that shard: rows move into subtrees that grew and
out of subtrees that shrank, and between any two untouched subtrees nothing
moves. A further shard is hung in as a region of its own (``Tree.grown``), so it
takes rows only into itself: law ``key``.

Built-in functions only. The tree is a literal of the plan (one entry per node);
placing a row needs no shuffle. Slots number the rows of a shard without a gap:
rows are ordered inside (shard, block of ids) only, and blocks start where the
counts of the earlier blocks end, so no task orders a whole shard.

Defined cases: a null key is hashed as the empty text (all such rows share a
shard); null text has size ``ROW_BYTES`` and the checksum of no bytes (0);
repeated rows each get their own slot; an empty table gives an empty result;
input columns named like an output column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickmarts.llm.columns import drop_named, fresh_prefix, hash_unit, running_total

ROW_BYTES = 16
SHARDS = 40
RACKS_PER_REGION = 5
SHARDS_PER_RACK = 4
# ids per slot block: 2^14 rows are ordered together at most (unless ids repeat)
BLOCK_BITS = 14


@dataclass(frozen=True)
class Tree:
    """Regions -> racks -> shards with the shard weights; ``regions[name][rack][shard] = weight``."""

    regions: dict[str, dict[str, dict[int, float]]]

    @classmethod
    def regular(cls, shards: int = SHARDS) -> Tree:
        """Equal shards: full regions of 5 racks of 4 shards for the first 40, then one region for each further shard."""
        per_region = RACKS_PER_REGION * SHARDS_PER_RACK
        regions: dict[str, dict[str, dict[int, float]]] = {}
        for s in range(min(shards, SHARDS)):
            rack = f"rack-{s // SHARDS_PER_RACK}"
            regions.setdefault(f"region-{s // per_region}", {}).setdefault(rack, {})[s] = 1.0
        tree = cls(regions)
        for s in range(SHARDS, shards):
            tree = tree.grown(s)
        return tree

    def grown(self, shard: int, weight: float = 1.0) -> Tree:
        """The tree with one more shard, in a region of its own."""
        return Tree({**self.regions, f"region-of-{shard}": {f"rack-of-{shard}": {shard: weight}}})

    def reweighted(self, shard: int, weight: float) -> Tree:
        return Tree(
            {
                g: {r: {s: weight if s == shard else w for s, w in sh.items()} for r, sh in racks.items()}
                for g, racks in self.regions.items()
            }
        )


def _weight(node: dict | float) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else float(node)


def _drawn(key: Column, children: Column) -> Column:
    """Name of the child with the smallest draw; ties go to the smaller name."""
    draws = F.transform(
        children,
        lambda c: F.struct((-F.log(hash_unit(c["name"], key)) / c["weight"]).alias("draw"), c["name"].alias("name")),
    )
    return F.array_min(draws)["name"]


def _children(nodes: dict[str, dict | float]) -> Column:
    live = sorted((str(k), _weight(v)) for k, v in nodes.items() if _weight(v) > 0)
    return F.array(*[F.struct(F.lit(k).alias("name"), F.lit(w).alias("weight")) for k, w in live])


def _lookup(nodes: dict[str, dict], parent: Column) -> Column:
    pairs = [x for k, v in sorted(nodes.items()) if _weight(v) > 0 for x in (F.lit(k), _children(v))]
    return F.element_at(F.create_map(*pairs), parent)


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard of a key: three weighted draws, one per level."""
    key = F.coalesce(key.cast("string"), F.lit(""))
    racks = {r: shards for g in tree.regions.values() for r, shards in g.items()}
    region = _drawn(key, _children(tree.regions))
    rack = _drawn(key, _lookup(tree.regions, region))
    named = {r: {f"shard-{s}": w for s, w in shards.items()} for r, shards in racks.items()}
    shard = _drawn(key, _lookup(named, rack))
    return F.substring_index(shard, "-", -1).cast("int")


def shard_rows(
    df: DataFrame, tree: Tree, grown: Tree | None = None, key: str = "doc_id", text: str | None = "text"
) -> DataFrame:
    """All rows and columns of ``df`` with size, text_crc32, law, shard, slot and grown_shard.

    ``key`` must be an integer column; ``grown_shard`` is the row's shard under
    ``grown`` (null without it).
    """
    body = F.coalesce(F.col(text), F.lit("")) if text else F.lit("")
    rows = drop_named(df, "size", "text_crc32", "law", "shard", "slot", "grown_shard").select(
        "*",
        (F.octet_length(body) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col(key), tree).alias("shard"),
        (shard_of(F.col(key), grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    # rows without an id are spread over blocks by their text, before all others
    lowest = F.lit(-(1 << 62))
    block = F.coalesce(F.shiftright(F.col(key).cast("long"), BLOCK_BITS), lowest + F.col("text_crc32") % F.lit(1 << 16))
    name = f"{fresh_prefix(rows)}block"
    rows = rows.withColumn(name, block)
    order = [F.col(key).asc_nulls_first(), F.col("text_crc32")]
    return running_total(rows, ["shard"], name, order, F.lit(1), "slot").drop(name)


def op1_shard(df: DataFrame) -> DataFrame:
    """The contract's columns for a documents table over shards 0 to 39."""
    tree = Tree.regular(SHARDS)
    narrow = df.select("doc_id", "text")
    out = shard_rows(narrow, tree, Tree.regular(SHARDS + 1))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


# The same rows in DuckDB SQL. crc32 is spelled out byte by byte (reflected
# polynomial 0xEDB88320 = 3988292384); the descent joins the nodes of the tree.
ORACLE_SQL = """
WITH RECURSIVE bits(b, c, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL
  SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
),
tab AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
docs AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS key, hex(encode(coalesce(text, ''))) AS h FROM documents
),
bytes AS (
  SELECT doc_id, key, length(h) // 2 + 16 AS size,
    list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT) AS b FROM docs
),
sums AS (
  SELECT doc_id, key, size, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
    lambda a, x: xor(a >> 8, t[xor(a, x) % 256 + 1])), 4294967295) AS crc FROM bytes, tab
),
leaf AS (
  SELECT s, CASE WHEN s < 40 THEN 'region-' || s // 20 ELSE 'region-of-' || s END AS region,
    CASE WHEN s < 40 THEN 'rack-' || s // 4 ELSE 'rack-of-' || s END AS rack FROM range(41) t(s)
),
nodes AS (
  SELECT '' AS parent, region AS name, count(*) AS w FROM leaf GROUP BY region
  UNION ALL SELECT region, rack, count(*) FROM leaf GROUP BY region, rack
  UNION ALL SELECT rack, 'shard-' || s, 1 FROM leaf
),
draws AS (
  SELECT doc_id, parent, name,
    -ln((('0x' || substr(md5(name || ':' || key), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / w AS draw
  FROM sums, nodes
),
won AS (
  SELECT doc_id, parent, arg_min(name, draw) AS grown, arg_min(name, draw) FILTER (name != 'region-of-40') AS base
  FROM draws GROUP BY ALL
),
placed AS (
  SELECT g.doc_id, split_part(s.base, '-', 2)::INT AS shard,
    CASE WHEN g.grown = 'region-of-40' THEN 40 ELSE split_part(s.base, '-', 2)::INT END AS grown_shard
  FROM won g JOIN won r ON g.parent = '' AND r.doc_id = g.doc_id AND r.parent = g.base
  JOIN won s ON s.doc_id = g.doc_id AND s.parent = r.base
)
SELECT doc_id, size, crc AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard
FROM sums JOIN placed USING (doc_id)
"""
