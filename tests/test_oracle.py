"""Every registered query against its SQL counterpart on the smallest test tables."""

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as entry
from clientlens.catalogue import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted(rows):
    return sorted(rows, key=lambda r: [(v is not None, str(type(v)), v) for v in r])


def test_every_query_has_a_counterpart():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = entry.queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    got = [tuple(_plain(r[c]) for c in columns) for r in frame.collect()]
    answer = duck.sql(entry.oracle_sql()[name])
    assert sorted(answer.columns) == columns
    places = [answer.columns.index(c) for c in columns]
    want = [tuple(_plain(r[p]) for p in places) for r in answer.fetchall()]
    assert got and _sorted(got) == _sorted(want)


def test_entry_is_the_mart(spark):
    frame = entry.entry(spark)
    assert frame.count() == 150 and "rfm_segment" in frame.columns
