"""Every registered query against its SQL twin, over whole tables."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, llm_queries, oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events"
    " documents embeddings pages benchmark labels conversations"
).split()
LLM = set(llm_queries)  # tested with their package
QUERIES = {key: query for key, query in queries().items() if key not in LLM}
ORACLE = {key: sql for key, sql in oracle_sql().items() if key not in LLM}


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def normal(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, duck, folder, key):
    frame = QUERIES[key](spark, folder)
    rows = frame.collect()
    result = duck.execute(ORACLE[key])
    columns = [c[0] for c in result.description]
    expected = result.fetchall()
    assert sorted(frame.columns) == sorted(columns)
    assert len(rows) > 0
    assert normal(rows, frame.columns) == normal(expected, columns)


def test_entry(spark):
    frame = entry(spark)
    assert "moyenne_mobile_7j" in frame.columns
    assert frame.count() > 0
