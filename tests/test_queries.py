"""Every query with SQL against DuckDB on the smallest tables, where they are present."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry
from quern import queries as core

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def norm(v):
    return ("nan" if math.isnan(v) else repr(round(v, 9) + 0.0)) if isinstance(v, float) else repr(v)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(core.SQL))
def test_query_equals_sql(spark, db, name):
    df = core.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    rel = db.sql(core.SQL[name])
    at = rel.columns
    assert sorted(at) == cols
    assert got == sorted(tuple(norm(r[at.index(c)]) for c in cols) for r in rel.fetchall())
