"""Every registered query against its SQL on the smallest test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from auricle_checks.registry import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(value) if isinstance(value, float) else str(value)


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in data)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    want = result.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table(names, want)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
