"""Every registered query against its SQL twin, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from reviewlens import catalog

# the training-data queries have tests of their own
LIBRARY = set(catalog.REGISTRY) | {"consensus", "completion"}
QUERIES = {k: v for k, v in entry_point.queries().items() if k in LIBRARY}
ORACLES = {k: v for k, v in entry_point.oracle_sql().items() if k in LIBRARY}
TABLES = ("customer", "supplier", "part", "lineitem", "events", "documents", "embeddings", "pages")
# without SQL
ROWS_ONLY = {"theme_map"}


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf, name)}.parquet'")
    return connection


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["app_id", "app_name", "total_reviews", "total_positive", "steam_consensus"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf, duck, name):
    found = QUERIES[name](spark, sf)
    columns = sorted(found.columns)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = sorted(repr([row[names.index(c)] for c in columns]) for row in result.fetchall())
    assert sorted(repr([row[c] for c in columns]) for row in found.collect()) == expected


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_runs(spark, sf, name):
    assert len(QUERIES[name](spark, sf).collect()) > 0
