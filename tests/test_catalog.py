"""Every query of the library against its SQL in DuckDB, on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

from tidelog.plans import catalog, streams

DIR = os.environ.get("TIDELOG_TEST_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = catalog.QUERIES | streams.QUERIES, catalog.SQL | streams.SQL

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return str(v.replace(tzinfo=None))
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    rel = duck.sql(SQL[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    want = sorted(repr(tuple(plain(r[i]) for i in at)) for r in rel.fetchall())
    got = sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    assert got == want


def test_throttled_flushes(spark):
    from tidelog.operators.transactions import throttled_flushes

    acks = spark.createDataFrame([("a", t, t) for t in (0, 40, 90, 130, 240)] + [("b", 5, 1)], "slot string, at long, position long")
    assert sorted(tuple(r) for r in throttled_flushes(acks, "slot", 100).collect()) == [("a", 0, 0), ("a", 130, 130), ("a", 240, 240), ("b", 5, 1)]
