"""Every registered query against its SQL, on the smallest check tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.queries import QUERIES, SQL

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no check tables")


@pytest.fixture(scope="module")
def engine():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_is_registered_with_its_sql():
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()
    assert set(SQL) <= set(QUERIES) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, engine, name):
    df = QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    rows = sorted(tuple(str(r[c]) for c in columns) for r in df.collect())
    result = engine.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert rows == sorted(tuple(str(r[i]) for i in order) for r in result.fetchall())
    assert rows


def test_entry(spark):
    assert entry.entry(spark).columns == ["chart", "label", "value"]
