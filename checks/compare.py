"""Runs registered queries in Spark and their SQL in DuckDB and compares rows: ``python -m checks.compare [names]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

from checks import oracle, registry
from lensmill.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def rows_match(names: list[str], got: list[tuple], con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """'' where equal, else a short description."""
    con.execute(sql)
    theirs = [c[0] for c in con.description]
    if sorted(theirs) != sorted(names):
        return f"columns {sorted(names)} against {sorted(theirs)}"
    order = sorted(range(len(names)), key=lambda i: names[i])
    their_order = sorted(range(len(theirs)), key=lambda i: theirs[i])
    ours = sorted(repr([r[i] for i in order]) for r in got)
    other = sorted(repr([r[i] for i in their_order]) for r in con.fetchall())
    if ours == other:
        return ""
    first = next(((a, b) for a, b in zip(ours, other) if a != b), ("", ""))
    return f"{len(ours)} rows against {len(other)}; first difference\n  {first[0]}\n  {first[1]}"


def main() -> int:
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, con, sql = local_session(), connect(sf_dir), oracle.oracle_sql()
    queries = registry.queries()
    bad = 0
    for name in sys.argv[1:] or queries:
        began = time.time()
        frame = queries[name](spark, sf_dir)
        got = [tuple(r) for r in frame.collect()]
        took = time.time() - began
        problem = rows_match(frame.columns, got, con, sql[name]) if name in sql else "rows only"
        bad += problem not in ("", "rows only")
        print(f"{name:34} {took:6.2f}s {len(got):7} rows  {problem or 'equal'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
