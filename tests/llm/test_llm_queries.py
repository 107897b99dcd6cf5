"""Every numbered query that has an SQL statement, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from vecloom.llm.queries import ORACLE, QUERIES

TABLES = Path("/root/testdata/sf0.001")
NAMES = "documents pages benchmark labels".split()


def normalized(frame):
    frame = frame[sorted(frame.columns)].astype(object).where(frame.notna(), None)
    rows = [tuple(repr(float(v) + 0.0) if isinstance(v, (float, int)) and not isinstance(v, bool) else str(v) for v in row) for row in frame.itertuples(index=False)]
    return list(frame.columns), sorted(rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for table in NAMES:
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TABLES}/{table}.parquet'")
    found = QUERIES[name](spark, str(TABLES)).toPandas()
    assert normalized(found) == normalized(database.execute(ORACLE[name]).fetchdf())
