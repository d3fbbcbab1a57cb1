"""Queries whose result SQL can state, against DuckDB on the same tables."""

import duckdb
import pytest

from ledgerlens.llm.queries import ORACLE_SQL, QUERIES
from odd_rows import SMALL

TABLES = ("documents", "pages", "conversations")


def plain(value):
    return float(value) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    df = QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == sorted(names)
    key = lambda r: [(v is not None, v) for v in r]
    got = sorted((tuple(r[n] for n in names) for r in df.collect()), key=key)
    assert got == sorted(want.fetchall(), key=key)
