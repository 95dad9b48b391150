from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pickmarts.schemas import ENRICHED_FACT_COLUMNS  # noqa: E402
from pickmarts.session import build_session  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
ORACLE_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "local[*]",
        app_name="pickmarts-tests",
        shuffle_partitions=8,
        # catalog tables (bucketed mart inputs) are external; keep the default database out of the repo
        extra_conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="pickmarts-test-wh-")},
    )
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own checkpoint folder; a cluster names a shared one.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pickmarts-test-ckpt-"))
    yield s
    s.stop()


FACT_SCHEMA = (
    "product_id string, warehouse_section string, origin int, order_number string, "
    "position_in_order string, pick_volume bigint, quantity_unit string, pick_timestamp timestamp_ntz, "
    "pick_date date, sk_order_id string, sk_position_in_order int, description string, product_group string"
)

D_DATE_SCHEMA = "date date, year int, week string, month string, quarter string, year_half string"


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def fact_row(
    product_id="000001",
    section="HRL",
    origin=48,
    order="00000001",
    position="0001",
    volume=1,
    when="2018-01-30 10:00:00",
    order_id=None,
    seq=1,
    description="d",
    group="G1",
):
    t = ts(when)
    sk = order_id if order_id is not None else f"{order}_{t.year}" if order is not None else None
    return (product_id, section, origin, order, position, volume, "St", t, t.date(), sk, seq, description, group)


def facts(spark, rows):
    assert len(ENRICHED_FACT_COLUMNS) == 13
    return spark.createDataFrame(rows, FACT_SCHEMA)


def calendar(spark, *days: str):
    from pickmarts.operators.calendar_dim import create_d_date

    out = None
    for d in days:
        one = create_d_date(spark, d, d)
        out = one if out is None else out.unionByName(one)
    return out


def rows_of(df, order=None):
    cols = order or df.columns
    return sorted(
        [tuple(r[c] for c in cols) for r in df.collect()],
        key=lambda t: tuple((x is None, str(x)) for x in t),
    )


def srt(rows):
    """Expected rows in the order ``rows_of`` returns them."""
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))
