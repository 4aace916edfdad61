"""Every registered core query against its SQL, on the smallest fixture."""

import datetime
import glob
import math
import os

import pytest

from kaghamar.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, float):
        return "null" if math.isnan(value) else f"{value:.9g}"
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return f"{float(value):.9g}" if abs(value) < 1 << 50 else str(value)
    return value.isoformat() if isinstance(value, datetime.datetime) else str(value)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no fixture")
    con = duckdb.connect()
    for path in glob.glob(SF + "/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    rows = QUERIES[name](spark, SF)
    mine = sorted(tuple(plain(r[c]) for c in sorted(rows.columns)) for r in rows.collect())
    if name not in ORACLE:
        assert mine
        return
    frame = duck.sql(ORACLE[name]).df()
    assert sorted(frame.columns) == sorted(rows.columns)
    theirs = sorted(tuple(plain(None if v is None or v != v else v.item() if hasattr(v, "item") else v) for v in r) for r in frame[sorted(frame.columns)].itertuples(index=False))
    assert mine == theirs


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
