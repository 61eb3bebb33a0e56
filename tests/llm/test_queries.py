"""Queries against their SQL, and against what the fixed patterns ask for."""

import duckdb
import pytest
from loglens.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    engine = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels", "embeddings"):
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    rows = QUERIES[name](spark, SF_DIR)
    columns = sorted(rows.columns)
    result = engine.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(str, map(tuple, rows.select(*columns).collect()))) == sorted(map(str, result))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_has_a_row_for_each_input_row(spark, name):
    table = "pages" if name.startswith("op7_") else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    rows, given = QUERIES[name](spark, SF_DIR), spark.read.parquet(f"{SF_DIR}/{table}.parquet")
    assert sorted(r[0] for r in rows.select(key).distinct().collect()) == sorted(r[0] for r in given.select(key).distinct().collect())
