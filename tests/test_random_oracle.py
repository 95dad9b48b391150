"""Differential test: every mart on random facts, Spark against the oracle's SQL in DuckDB.

The driver tables never hold NULL order numbers, NULL sections, a third origin
or equal order volumes; these random facts do (seeded, so failures repeat).
The oracle's mart SQL runs unchanged with its input tables swapped for them.
"""

from __future__ import annotations

import datetime as dt
import random

import duckdb
import pyarrow as pa
import pytest

import duckdb_oracle
from conftest import FACT_SCHEMA
from pickmarts.operators.calendar_dim import create_d_date
from pickmarts.plans.registry import MARTS, Facts

CAL_START, CAL_END = "2018-01-08", "2018-01-28"


def _random_facts(seed: int, n: int, volume_zero: bool):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        order = rnd.choice(["00000001", "00000002", "00000003", "00000004", "00000005", None])
        day = dt.date(2018, 1, 1) + dt.timedelta(days=rnd.randrange(0, 40))  # calendar covers days 7..27
        ts = dt.datetime.combine(day, dt.time(rnd.randrange(0, 24), rnd.randrange(0, 60)))
        volume = 0 if volume_zero else rnd.choice([1, 5, 10, 50, 51, 150, 151, 400, 700, 1000, 250000])
        rows.append(
            (
                rnd.choice(["P1", "P2", "P3", "P4", "P5"]),
                rnd.choice(["AKL", "HRL", "Manuell", None]),
                rnd.choice([46, 48, 48, 47]),
                order,
                "0001",
                volume,
                "St",
                ts,
                day,
                None if order is None else f"{order}_{day.year}",
                1,
                "desc",
                rnd.choice(["G1", "G2", None]),
            )
        )
    return rows


@pytest.fixture(scope="module", params=[1, 2, 3])
def case(request, spark):
    seed = request.param
    picks = _random_facts(seed, 300, False)
    errors = _random_facts(seed + 100, 60, True)
    f = spark.createDataFrame(picks, FACT_SCHEMA)
    e = spark.createDataFrame(errors, FACT_SCHEMA)
    d = create_d_date(spark, CAL_START, CAL_END)
    con = duckdb.connect()
    con.register("rf", f.toArrow())
    con.register("re", e.toArrow())
    return Facts(f, e, d), con


RANDOM_PICKS = f"""
WITH picks AS (
  SELECT *, CASE WHEN pick_date BETWEEN DATE '{CAL_START}' AND DATE '{CAL_END}' THEN pick_date END AS day
  FROM (FROM rf UNION ALL FROM re)
),
f AS (SELECT * FROM picks WHERE pick_volume > 0),
days AS (SELECT unnest(generate_series(DATE '{CAL_START}', DATE '{CAL_END}', INTERVAL 1 DAY))::DATE AS day)
"""


@pytest.fixture(scope="module")
def mart_sql():
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(duckdb_oracle, "PICKS", RANDOM_PICKS)
        patch.setattr(duckdb_oracle, "CALENDAR_START", CAL_START)
        patch.setattr(duckdb_oracle, "CALENDAR_END", CAL_END)
        sql = duckdb_oracle.oracle_queries()
    return {k: v for k, v in sql.items() if k in MARTS}


def _cells(table: pa.Table):
    cols = sorted(table.column_names)

    def norm(v):
        if v is None or (isinstance(v, float) and v != v):
            return "<NULL>"
        return repr(v) if isinstance(v, float) else str(v)

    return sorted(zip(*[[norm(v) for v in table.column(c).to_pylist()] for c in cols]))


@pytest.mark.parametrize("name", sorted(MARTS))
def test_mart_matches_sql(case, mart_sql, name):
    facts, con = case
    got = MARTS[name].build(facts)
    got = got.toArrow()
    want = con.sql(mart_sql[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert got.num_rows == want.num_rows, name
    assert _cells(got) == _cells(want), name
