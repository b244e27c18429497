"""Every query with SQL gives the SQL's rows on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

from ledgerleaf.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return f"{float(value):.9g}"
    return str(value) if isinstance(value, (datetime.date, datetime.datetime)) else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    if name in ORACLE_SQL:
        rel = con.sql(ORACLE_SQL[name])
        assert sorted(rel.columns) == columns
        order = [rel.columns.index(c) for c in columns]
        assert got == sorted(repr([plain(r[k]) for k in order]) for r in rel.fetchall())
