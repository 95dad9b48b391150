"""Mixing: documents of one source have inclusion probabilities of their own, and the sample follows them."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pickmarts.llm import mixing


@pytest.fixture(scope="module")
def mixed(spark):
    # sizes from 1 to 1000, most of them small; one source is far below its share and stops at its cap
    ids = spark.range(30000).withColumn("doc_id", F.col("id"))
    size = F.floor(F.pow(F.lit(10.0), F.pmod(F.xxhash64("id"), F.lit(3000)) / 1000)).cast("long")
    source = F.when(F.col("id") % 50 == 0, "small").when(F.col("id") % 3 == 0, F.lit(None)).otherwise("large")
    docs = ids.select("doc_id", source.alias("source"), size.alias("words"))
    return mixing.mix(docs, F.col("words")).collect()


def _sources(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    return by


def test_expectations_stand_for_the_target(mixed):
    for rows in _sources(mixed).values():
        whole = sum(r["size"] * (r["copies"] - _drawn(r)) for r in rows)
        parts = sum(r["size"] * r["inclusion"] for r in rows)
        assert whole + parts == pytest.approx(rows[0]["target"], rel=1e-9)
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= max(r["size"] for r in rows) / 2 + 1


def _drawn(r) -> int:
    """1 where the copy beyond the certain ones was drawn: the certain ones follow from the favour."""
    return r["copies"] - CERTAIN[r["source"], len(bin(r["size"])) - 2]


CERTAIN: dict = {}


@pytest.fixture(autouse=True)
def certain(mixed):
    least: dict = {}
    for r in mixed:
        key = r["source"], len(bin(r["size"])) - 2
        least[key] = min(r["copies"], least.get(key, 9))
    CERTAIN.update(least)


def test_longer_documents_are_wanted_more(mixed):
    classes = defaultdict(set)
    for r in mixed:
        classes[r["source"]].add((len(bin(r["size"])) - 2, CERTAIN[r["source"], len(bin(r["size"])) - 2] + r["inclusion"]))
    for source, found in classes.items():
        wanted = dict(found)
        assert len(found) == len(wanted)  # one expectation a class
        order = [wanted[k] for k in sorted(wanted)]
        assert order == sorted(order) and max(order) <= 2
        # in proportion to the digits below the cap
        free = [wanted[k] / k for k in wanted if wanted[k] < 2]
        assert not free or max(free) == pytest.approx(min(free))
        if source == "large":
            assert len({round(r, 9) for r in order}) > 5


def test_sample_follows_the_inclusion_odds(mixed):
    drawn, p, n = Counter(), {}, Counter()
    for r in mixed:
        key = r["source"], len(bin(r["size"])) - 2
        p[key] = r["inclusion"]
        n[key] += 1
        drawn[key] += _drawn(r)
    large = [k for k in n if n[k] >= 300 and 0 < p[k] < 1]
    assert len(large) > 5
    for k in large:
        assert abs(drawn[k] / n[k] - p[k]) < 5 * (p[k] * (1 - p[k]) / n[k]) ** 0.5 + 0.01


def test_ranks_decide(mixed):
    """The documents drawn in a source are those of the smallest ranks, in words up to the line."""
    for rows in _sources(mixed).values():
        ranked = sorted((r["rank"], r["doc_id"], _drawn(r)) for r in rows if r["rank"] is not None)
        flags = [d for _, _, d in ranked]
        assert flags == sorted(flags, reverse=True)


def test_blocks_are_even_whatever_the_odds(spark):
    """Nearly certain and nearly hopeless classes side by side: no block of ranks holds much of the source."""
    rows = spark.range(20000).select(
        F.when(F.col("id") % 2 == 0, 1e-6).otherwise(1 - 1e-6).alias("p"),
        ((F.pmod(F.xxhash64("id"), F.lit(1 << 30)) + 0.5) / (1 << 30)).alias("u"),
    )
    odds = F.col("p") / (1.0 - F.col("p"))
    classes = F.array(
        *[F.struct(F.lit(10000).alias("n"), F.lit(p / (1 - p)).alias("odds")) for p in (1e-6, 1 - 1e-6)]
    )
    share = mixing._share_below(F.col("u") / (1.0 - F.col("u")) / odds, classes)
    found = rows.groupBy(F.floor(share * 64).alias("block")).count().collect()
    assert len(found) == 64 and max(r["count"] for r in found) < 2 * 20000 / 64
