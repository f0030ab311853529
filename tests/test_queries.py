"""Every named query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from ledgersieve.queries.oracle import all_oracles
from ledgersieve.queries.registry import all_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in sorted(Path(FOLDER).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, tables, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    found = [tuple(row[c] for c in columns) for row in df.collect()]
    result = tables.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = [tuple(row[i] for i in places) for row in result.fetchall()]
    assert ordered(found) == ordered(expected)
    assert found


def test_entry(spark):
    assert entry.entry(spark).count() == 1500
