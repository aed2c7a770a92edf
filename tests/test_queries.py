"""Every query against its check SQL in DuckDB, and the contract of the registry."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module
from shelfcast import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
QUERIES, CHECKS = catalog.QUERIES, catalog.CHECKS
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value + 0.0 if isinstance(value, float) else value


def bag(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def test_every_check_belongs_to_a_query():
    assert set(CHECKS) <= set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    expected = duck.sql(CHECKS[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == dict(zip(expected.columns, map(str, expected.types)))
    assert bag(df.collect(), df.columns) == bag(expected.fetchall(), expected.columns)


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.count() == 6000
    assert "item_id_avg_sales" in df.columns
