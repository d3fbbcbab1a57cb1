"""Runs registered queries and their oracle SQL side by side.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

KINDS = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


def oracle_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{sf_dir}/events.parquet'")
    result = con.execute(sql)
    types = {c[0]: str(c[1]) for c in result.description}
    return types, result.fetchall()


def _key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def mismatch(df, sf_dir: str, sql: str) -> str | None:
    """What differs between a Spark result and its oracle, or None."""
    types, want = oracle_rows(sf_dir, sql)
    names = sorted(df.columns)
    if names != sorted(types):
        return f"columns {names} != {sorted(types)}"
    spark_types = dict(df.dtypes)
    off = {n: (spark_types[n], types[n]) for n in names if KINDS.get(types[n]) != spark_types[n]}
    order = [list(types).index(n) for n in names]
    want = sorted((tuple(r[i] for i in order) for r in want), key=_key)
    got = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_key)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{dict(zip(names, g))} != {dict(zip(names, w))}"
    return f"types {off}" if off else None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from ledgerlens.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            found = mismatch(df, sf_dir, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed = bool(found) and not found.startswith("rows only")
        bad += failed
        print(f"{'FAIL' if failed else 'ok  '} {time.time() - start:6.1f}s {name} {found or ''}", flush=True)
    print(f"{bad} failures; oracles without query: {sorted(set(oracles) - set(queries))}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
