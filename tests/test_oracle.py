"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry
from tidemark.checks.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS FROM '{FOLDER}/{name}.parquet'")
    return connection


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(None if r[i] is None else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    mine = bag(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(ORACLES[name])
    assert mine == bag([c[0] for c in result.description], result.fetchall())


def test_entry_returns_rows(spark):
    assert entry(spark).count() > 0
