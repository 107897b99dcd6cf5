"""Every registered query against its SQL statement, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from vecloom.catalog.queries import QUERIES

TABLES = Path("/root/testdata/sf0.001")
NAMES = "documents embeddings pages benchmark conversations".split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{name}.parquet'")
    return connection


def normalized(frame):
    frame = frame[sorted(frame.columns)]
    rows = [tuple(repr(float(v) + 0.0) if isinstance(v, float) else str(v) for v in row) for row in frame.itertuples(index=False)]
    return list(frame.columns), sorted(rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    found = contract.queries()[name](spark, str(TABLES)).toPandas()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert len(found) > 0
        return
    assert normalized(found) == normalized(database.execute(sql).fetchdf())


def test_every_query_is_registered():
    assert set(QUERIES) <= set(contract.queries())


def test_every_statement_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
