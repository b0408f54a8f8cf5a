"""Queries against their SQL where event ids, and what is made of them, are as large as in tables of many times the usual size."""

import datetime

import duckdb
import pytest

from tidelog.plans import catalog, streams

QUERIES, SQL = catalog.QUERIES | streams.QUERIES, catalog.SQL | streams.SQL


@pytest.fixture(scope="module")
def large_ids(spark, tmp_path_factory):
    """Events on both sides of the ids at which a position made of them passes 2^32."""
    top = tmp_path_factory.mktemp("large")
    at = datetime.datetime(2024, 1, 1)
    rows = [(i, at + datetime.timedelta(seconds=i), i % 7, ("view", "click", "error")[i % 3], i / 4, None) for first in (409_500, 542_300, 5_999_900) for i in range(first, first + 120)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(f"{top}/events.parquet")
    return str(top)


@pytest.mark.parametrize("name", ["cdc_lsn_roundtrip", "stream_ordered_publish", "stream_retry_publish"])
def test_same_rows(spark, large_ids, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{large_ids}/events.parquet/*.parquet'")
    df = QUERIES[name](spark, large_ids)
    rel = con.sql(SQL[name])
    at = [rel.columns.index(c) for c in df.columns]
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(repr(tuple(r[i] for i in at)) for r in rel.fetchall())
