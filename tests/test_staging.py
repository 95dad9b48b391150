"""Headerless latin-1 CSV read as the original loader reads it."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pandas as pd
import pytest

from pickmarts.schemas import RAW_PICK_DATA, RAW_PRODUCT_DETAILS, STAGED_PICK_COLUMNS
from pickmarts.sources.staging import read_pick_data, read_product_details, read_warehouse_sections

NOON = "2021-05-04 12:00:00.000000"


def _write(text: str, name: str) -> str:
    d = tempfile.mkdtemp(prefix="pickmarts-csv-")
    p = os.path.join(d, name)
    with open(p, "wb") as fh:
        fh.write(text.encode("iso-8859-1"))
    return p


def _picks(spark, *lines: str, **options):
    return read_pick_data(spark, _write("\n".join(lines) + "\n", "picks.csv"), **options)


def test_columns_and_types(spark):
    df = _picks(spark, f"x1,north,48,o1,p1,24,pc,{NOON}")
    assert df.columns == list(STAGED_PICK_COLUMNS)
    types = dict(df.dtypes)
    assert types["origin"] == "int" and types["pick_volume"] == "bigint"
    assert types["pick_timestamp"] == "timestamp_ntz" and types["pick_date"] == "date"


# lines the original loader accepts, with its reading of origin, volume and date
ACCEPTED = [
    (f"007,north,48,0010,02,24,pc,{NOON}", 48, 24, dt.datetime(2021, 5, 4, 12)),
    ("x,north,46,o,p,-3,pc,2021-05-04 23:59:59.123456", 46, -3, dt.datetime(2021, 5, 4, 23, 59, 59, 123456)),
    ("x,north,46,o,p,0,pc,2021-05-04 01:02:03.5", 46, 0, dt.datetime(2021, 5, 4, 1, 2, 3, 500000)),
    (f"x,north, 46,o,p, 7,pc,{NOON}", 46, 7, dt.datetime(2021, 5, 4, 12)),
    (f"x,north,+46,o,p,+7,pc,{NOON}", 46, 7, dt.datetime(2021, 5, 4, 12)),
    ("x,north,46,o,p,7,pc,", 46, 7, None),
    ("x,north,46,o,p,7", 46, 7, None),
    ("x,north,46,o,p,7,pc,2021-5-4 1:02:03.25", 46, 7, dt.datetime(2021, 5, 4, 1, 2, 3, 250000)),
    ("x,north,46,o,p,7,pc,2021-05-04 01:02:03.123456789", 46, 7, dt.datetime(2021, 5, 4, 1, 2, 3, 123456)),
]


@pytest.mark.parametrize("line, origin, volume, when", ACCEPTED)
def test_accepted_like_pandas(spark, line, origin, volume, when):
    row = _picks(spark, line).collect()[0]
    assert (row["origin"], row["pick_volume"], row["pick_timestamp"]) == (origin, volume, when)
    assert row["pick_date"] == (when.date() if when else None)
    names = [f.name for f in RAW_PICK_DATA.fields]
    kinds = {n: str for n in names} | {"origin": int, "pick_volume": int}
    want = pd.read_csv(_write(line + "\n", "p.csv"), header=None, names=names, dtype=kinds, encoding="iso-8859-1").iloc[0]
    assert (want["origin"], want["pick_volume"]) == (origin, volume)
    stamp = pd.to_datetime(want["date"], format="%Y-%m-%d %H:%M:%S.%f")
    assert (None if pd.isna(stamp) else stamp.floor("us").to_pydatetime()) == when
    for c in ("product_id", "warehouse_section", "order_number", "position_in_order", "quantity_unit"):
        assert row[c] == (None if pd.isna(want[c]) else want[c])


@pytest.mark.parametrize(
    "line",
    [
        f"x,north,,o,p,24,pc,{NOON}",
        f"x,north,4x,o,p,24,pc,{NOON}",
        f"x,north,48,o,p,,pc,{NOON}",
        f"x,north,48,o,p,2.5,pc,{NOON}",
        "x,north,48,o,p,24,pc,2021-05-04 12:00:00",
        "x,north,48,o,p,24,pc,2021-13-04 12:00:00.0",
        f"x,north,48,o,p,24,pc,{NOON},surplus",
        "x",
    ],
)
def test_rejected(spark, line):
    with pytest.raises(Exception):
        _picks(spark, line).collect()


def test_lists_like_pandas(spark):
    text = 'a1,"Desk lamp, ""warm""",light\nb2,"Rack\nÄÖÜ",metal\nc3,NULL,nan\nd4,,x\ne5\n'
    p = _write(text, "products.csv")
    names = [f.name for f in RAW_PRODUCT_DETAILS.fields]
    want = pd.read_csv(p, header=None, names=names, dtype=str, encoding="iso-8859-1")
    want = [tuple(None if pd.isna(v) else v for v in r) for r in want.itertuples(index=False)]
    assert sorted(map(tuple, read_product_details(spark, p).collect())) == sorted(want)
    sections = read_warehouse_sections(spark, _write("N,north hall,hall,Ü1\nS,south hall,hall,N/A\n", "sections.csv"))
    assert sorted(map(tuple, sections.collect())) == [("N", "north hall", "hall", "Ü1"), ("S", "south hall", "hall", None)]


def test_a_large_file_is_read_by_several_tasks(spark):
    path = _write("".join(f"x{i},north,48,o{i},p,{i},pc,{NOON}\n" for i in range(200_000)), "picks.csv")
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2m")
    try:
        df = read_pick_data(spark, path)
        assert df.rdd.getNumPartitions() > 2
        assert df.count() == 200_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
