"""Driver contract and the DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as se
from conftest import SMOKE_DIR
from duckdb_oracle import oracle_queries
from pickmarts.plans.driver_queries import all_queries


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.columns == ["date", "pick_volume", "week", "month", "quarter", "year_half", "year"]
    assert df.count() > 0


def test_every_mart_query_has_an_oracle():
    assert set(all_queries()) == set(oracle_queries())
    assert set(all_queries()) <= set(se.queries()) and set(se.oracle_sql()) <= set(se.queries())


def _cells(table):
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]

    def norm(v):
        if v is None or (isinstance(v, float) and v != v):
            return "<NULL>"
        return repr(v) if isinstance(v, float) else str(v)

    return sorted(zip(*[[norm(v) for v in col] for col in data]))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("lineitem", "part", "supplier", "nation"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMOKE_DIR, t)}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(oracle_queries()))
def test_query_matches_oracle(spark, duck, name):
    got = se.queries()[name](spark, SMOKE_DIR).toArrow()
    want = duck.sql(se.oracle_sql()[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert got.num_rows == want.num_rows
    assert _cells(got) == _cells(want)
