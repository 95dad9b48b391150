"""Operator 7, mixing sources to target weights by Pareto order sampling.

Sources share ``budget`` times all words by weight; a target stops at
``most`` times its source's words and the excess is shared again by weight among
the others until none is above (solved in one step: sources are capped in the
order of words per weight).

Inside a source a document is wanted in proportion to its ``favour``, a small
positive whole number (by default the binary digits of its word count, so that
longer documents are wanted more, slowly): its expected copies are
min(most, level * favour), the source's level being such that they stand for its
target in words (solved in one step over the classes of equal favour, heaviest
first). The whole part of the expectation is allocated for certain; the remainder p is
the document's inclusion probability, which differs between the classes, sampled
without replacement by Pareto order sampling: documents are ranked by their
random odds over their inclusion odds, (u / (1-u)) / (p / (1-p)), and the
smallest ranks are taken. The sample's size is fixed in words: documents are
taken in rank order up to the words that the remainders stand for, and the
document across that line is taken if its larger half lies below. u is hashed
from the document, so reruns agree.

Built-in functions only. Ranks are never ordered in one task: blocks of the rank
are summed first, and rows are ordered inside (source, block). A rank's block is the
share of the source's documents expected below it, from the classes' sizes and
odds, so that a source's block holds about 1/4096 of it whatever its odds. The
table of sources, a row each with at most one entry per favour, is written
and joined; Spark broadcasts it while its size allows and splits a hot source else.

Defined cases: null text has no words; null source is a source (last); a source
without words takes nothing; documents with equal ids share u and are ordered by
their text's checksum; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pickmarts.llm.columns import drop_named, hash_unit, running_total, word_count, written

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST = 2
RANK_BLOCKS = 1 << 12
# words are whole numbers; this only absorbs rounding of the fractional targets
SLACK = 1e-6


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET) -> DataFrame:
    """One row per source: __key, source_size, target, from rows with columns __key (non-null) and __size."""
    per = sized.groupBy("__key").agg(F.sum("__size").alias("source_size"))
    by_name = Window.orderBy("__key")
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    per = per.withColumn("__w", F.element_at(F.array(*[F.lit(w) for w in weights]), turn.cast("int") + 1))
    # caps bind in the order of words per weight; before a source come all with fewer
    fill = Window.orderBy(F.col("source_size") / F.col("__w"), "__key")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) * F.lit(budget) - F.lit(MOST) * F.coalesce(
        F.sum("source_size").over(before), F.lit(0)
    )
    weight_left = F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(before), F.lit(0))
    level = F.col("__left") / F.col("__weight_left")
    per = per.withColumn("__left", left).withColumn("__weight_left", weight_left).withColumn("__level", level)
    # the water level is that of the first source it does not drown
    fits = F.col("__level") * F.col("__w") <= F.lit(MOST) * F.col("source_size")
    level = F.min(F.when(fits, F.struct(F.col("source_size") / F.col("__w"), "__key", "__level"))).over(everything)
    per = per.withColumn("__level", level["__level"])
    cap = (F.lit(MOST) * F.col("source_size")).cast("double")
    target = F.coalesce(F.least(cap, F.col("__level") * F.col("__w")), cap)
    return per.select("__key", "source_size", target.alias("target"))


def _source_key(source: Column) -> Column:
    # a null sorts after every name
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def source_levels(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per source: its targets' row, __level, __rest and __classes; ``sized`` has __key, __size and __favour.

    __level is the copies per unit of favour (null: all are at the cap), __rest the
    words that the remainders stand for; __classes holds the number of documents and
    the odds of the remainder of every favour that is sampled.
    """
    per = sized.groupBy("__key", "__favour").agg(F.sum("__size").alias("__words"), F.count("*").alias("__rows"))
    per = per.join(targets, "__key")
    # caps bind from the heaviest class on; the level is that of the first class it keeps below the cap
    heavy = Window.partitionBy("__key").orderBy(F.desc("__favour"))
    before = F.coalesce(F.sum("__words").over(heavy.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weighed = F.sum(F.col("__words") * F.col("__favour")).over(heavy.rowsBetween(0, Window.unboundedFollowing))
    level = F.when(weighed > 0, (F.col("target") - F.lit(MOST) * before) / weighed)
    per = per.withColumn("__own", level)
    fits = F.col("__own") * F.col("__favour") <= F.lit(MOST)
    found = F.max(F.when(fits, F.struct("__favour", "__own"))).over(Window.partitionBy("__key"))["__own"]
    per = per.withColumn("__level", found)
    per = per.withColumn("__whole", F.floor(_expected()) * F.col("__words")).withColumn("__part", _remainder(_expected()))
    entry = F.struct("__favour", F.col("__rows").alias("n"), (F.col("__part") / (1.0 - F.col("__part"))).alias("odds"))
    classes = F.sort_array(F.collect_list(F.when(F.col("__part") > 0, entry))).alias("__classes")
    sources = per.groupBy("__key", "source_size", "target", "__level").agg(F.sum("__whole").alias("__whole"), classes)
    return sources.withColumn("__rest", F.col("target") - F.col("__whole")).drop("__whole")


def _expected() -> Column:
    """Expected copies of a row with __level, __favour and source_size."""
    most = F.lit(float(MOST))
    return F.when(F.col("source_size") > 0, F.coalesce(F.least(most, F.col("__level") * F.col("__favour")), most)).otherwise(0.0)


def _remainder(expected: Column) -> Column:
    return expected - F.floor(expected)


def _share_below(rank: Column, classes: Column) -> Column:
    """The share of a source's sampled documents that are expected at smaller ranks; never falls as the rank grows."""
    # of a class with odds o, a rank below r needs u / (1-u) < r * o
    below = F.aggregate(classes, F.lit(0.0), lambda s, c: s + c["n"] * (1.0 - 1.0 / (1.0 + rank * c["odds"])))
    return below / F.aggregate(classes, F.lit(0.0), lambda s, c: s + c["n"])


def mix(
    df: DataFrame,
    size: Column,
    doc_id: str = "doc_id",
    source: str = "source",
    tie: Column | None = None,
    sums: DataFrame | None = None,
    favour: Column | None = None,
) -> DataFrame:
    """All rows and columns of ``df`` with size, source_size, target, inclusion, rank, copies and taken.

    ``size`` counts a row's words and ``tie`` orders rows of one id. ``favour`` is a
    row's weight inside its source, a positive whole number of few distinct
    values. inclusion is the probability of the copy beyond the certain ones,
    taken the words with repeats counted. ``sums`` may give a cheaper DataFrame of
    the same rows to take the totals from, with columns ``doc_id``, ``source``,
    ``__size`` and, if ``favour`` is given, ``__favour``. Columns of ``df`` with the names of the results go; others
    must not begin with two underscores.
    """
    df = drop_named(df, "size", "source_size", "target", "inclusion", "rank", "copies", "taken")
    rows = df.withColumn("__key", _source_key(F.col(source))).withColumn("__size", size.cast("long"))
    rows = rows.withColumn("__favour", (favour if favour is not None else _digits(F.col("__size"))).cast("long"))
    rows = rows.withColumn("__tie", tie if tie is not None else F.lit(0))
    base = rows
    if sums is not None:
        weight = F.col("__favour") if favour is not None else _digits(F.col("__size"))
        base = sums.select(
            F.col(doc_id), _source_key(F.col(source)).alias("__key"), "__size", weight.cast("long").alias("__favour")
        )
    levels = written(source_levels(base, source_targets(base)), "mix-sources")

    def drawn(d: DataFrame) -> DataFrame:
        d = d.join(levels.withColumnRenamed("__key", "__of"), F.col("__key") == F.col("__of"), "left").drop("__of")
        u = hash_unit(F.lit("mix"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
        d = d.withColumn("__u", u).withColumn("__expected", _expected()).withColumn("__p", _remainder(F.col("__expected")))
        odds = F.col("__u") / (1.0 - F.col("__u"))
        d = d.withColumn("__rank", F.when(F.col("__p") > 0, odds / (F.col("__p") / (1.0 - F.col("__p")))))
        # rows that are not sampled count nothing in the order; they spread by u
        share = F.when(F.col("__rank").isNotNull(), _share_below(F.col("__rank"), F.col("__classes"))).otherwise(F.col("__u"))
        d = d.withColumn("__block", F.floor(share * RANK_BLOCKS).cast("long")).drop("__classes")
        return d.withColumn("__sampled", F.when(F.col("__rank").isNotNull(), F.col("__size")).otherwise(0))

    order = [F.col("__rank"), F.col(doc_id), F.col("__tie")]
    out = running_total(drawn(rows), ["__key"], "__block", order, F.col("__sampled"), "__earlier", totals_from=drawn(base))
    chosen = F.col("__rank").isNotNull() & (2 * F.col("__earlier") + F.col("__size") <= 2 * F.col("__rest") + SLACK)
    out = out.withColumn("copies", F.floor("__expected").cast("long") + F.when(chosen, 1).otherwise(0))
    return out.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("__size").alias("size"),
        "source_size",
        "target",
        F.col("__p").alias("inclusion"),
        F.col("__rank").alias("rank"),
        "copies",
        (F.col("copies") * F.col("__size")).alias("taken"),
    )


def _digits(size: Column) -> Column:
    return F.length(F.bin(size))


def op7_mix(df: DataFrame) -> DataFrame:
    """The contract's columns for a documents table."""
    # the texts are read once: both the totals and the rows come from this narrow table
    narrow = df.select("doc_id", "source", word_count(F.col("text")).alias("__size"), F.crc32(F.col("text").cast("binary")).alias("__crc"))
    narrow = written(narrow, "mix")
    out = mix(narrow, F.col("__size"), tie=F.col("__crc"), sums=narrow)
    return out.select("doc_id", "size", "source_size", "target", "taken", "inclusion", "copies")


def mixed_documents(df: DataFrame) -> DataFrame:
    """The documents of the mix: each row as many times as it is taken, columns unchanged."""
    size = word_count(F.col("text"))
    narrow = written(df.select("doc_id", "source", size.alias("__size")), "mix")
    # the caller's columns travel as one, so that none is taken for a column of the mix
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole")
    rows = df.select(whole, "doc_id", "source", size.alias("__words"), F.crc32(F.col("text").cast("binary")).alias("__crc"))
    out = mix(rows, F.col("__words"), tie=F.col("__crc"), sums=narrow)
    copies = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return out.select("whole", copies.alias("copy")).select(*[F.col(f"whole.`{c}`").alias(c) for c in df.columns])


# The same rows in DuckDB SQL: targets by reaching the water level source by
# source, a source's level class by class, the sample by one ordered running sum per source.
ORACLE_SQL = """
WITH docs AS (
  SELECT doc_id, coalesce('0' || source, '1') AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents
),
src AS (
  SELECT key, sum(size)::BIGINT AS s, CASE (row_number() OVER (ORDER BY key) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM docs GROUP BY key
),
levels AS (
  SELECT a.key, a.s, a.w, ((SELECT sum(s) FROM src) * 1.5::DOUBLE
      - 2 * coalesce((SELECT sum(s) FROM src b WHERE b.s / b.w < a.s / a.w OR (b.s / b.w = a.s / a.w AND b.key < a.key)), 0))
    / ((SELECT sum(w) FROM src)
      - coalesce((SELECT sum(w) FROM src b WHERE b.s / b.w < a.s / a.w OR (b.s / b.w = a.s / a.w AND b.key < a.key)), 0)) AS level
  FROM src a
),
water AS (SELECT arg_min(level, s / w) AS level FROM levels WHERE level * w <= 2 * s),
targets AS (
  SELECT key, s, least(2.0::DOUBLE * s, (SELECT level FROM water) * w) AS target FROM src
),
classes AS (
  SELECT key, len(bin(size)) AS favour, sum(size)::BIGINT AS words, any_value(s) AS s, any_value(target) AS target
  FROM docs JOIN targets USING (key) GROUP BY key, favour
),
owned AS (
  SELECT c.key, c.favour, (c.target - 2 * (SELECT coalesce(sum(h.words), 0) FROM classes h WHERE h.key = c.key AND h.favour > c.favour))
    / nullif((SELECT sum(l.words * l.favour) FROM classes l WHERE l.key = c.key AND l.favour <= c.favour), 0) AS own
  FROM classes c
),
wanted AS (SELECT key, arg_max(own, favour) AS per_favour FROM owned WHERE own * favour <= 2 GROUP BY key),
expected AS (
  SELECT key, favour, words, s, target,
    CASE WHEN s > 0 THEN coalesce(least(2.0::DOUBLE, per_favour * favour), 2.0::DOUBLE) ELSE 0 END AS e
  FROM classes LEFT JOIN wanted USING (key)
),
rests AS (SELECT key, any_value(target) - sum(floor(e) * words) AS rest FROM expected GROUP BY key),
odds AS (
  SELECT doc_id, size, s, target, rest, floor(e)::BIGINT AS whole, e - floor(e) AS p, d.key,
    (('0x' || substr(md5('mix:' || doc_id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM docs d JOIN expected x ON x.key = d.key AND x.favour = len(bin(d.size)) JOIN rests r ON r.key = d.key
),
ranked AS (
  SELECT *, sum(CASE WHEN p > 0 THEN size ELSE 0 END)
    OVER (PARTITION BY key ORDER BY CASE WHEN p > 0 THEN u / (1 - u) / (p / (1 - p)) END NULLS FIRST, doc_id ROWS UNBOUNDED PRECEDING) - size AS earlier
  FROM odds
),
counted AS (
  SELECT *, whole + CASE WHEN p > 0 AND 2 * earlier + size <= 2 * rest + 1e-6 THEN 1 ELSE 0 END AS copies FROM ranked
)
SELECT doc_id, size::BIGINT AS size, s AS source_size, target, (size * copies)::BIGINT AS taken, p AS inclusion, copies::BIGINT AS copies
FROM counted
"""
