"""Queries with a twin, over whole tables, and the registration of all."""

from __future__ import annotations

import duckdb
import pytest

from comptoir.llm.queries import oracle_sql, queries

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_twin(spark, folder, key):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    result = connection.execute(oracle_sql()[key])
    columns = sorted(c[0] for c in result.description)
    frame = queries()[key](spark, folder)
    assert sorted(frame.columns) == columns
    expected = [dict(zip((c[0] for c in result.description), row)) for row in result.fetchall()]
    normal = lambda rows: sorted(repr([row[c] for c in columns]) for row in rows)
    assert normal(frame.collect()) == normal(expected)


def test_one_query_per_operator():
    numbers = sorted(int(key[2:].split("_")[0]) for key in queries())
    assert numbers == list(range(1, 14))
