"""Compare registered queries with their SQL counterparts in DuckDB.

usage: check.py TABLE_FOLDER [QUERY ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pageloom.catalog import ORACLES, QUERIES  # noqa: E402
from pageloom.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _value(value: object) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value:.6g}"
    return f"{type(value).__name__}:{value}"


def _rows(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_value(row[i]) for i in order) for row in rows)


def compare(
    columns: list[str], rows: list[tuple], con: duckdb.DuckDBPyConnection, sql: str
) -> tuple[int, str | None]:
    """Number of rows, and what differs (None if nothing does)."""
    got_columns, got = _rows(columns, rows)
    result = con.execute(sql)
    want_columns, want = _rows([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return len(got), f"columns {got_columns} != {want_columns}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        missing = [r for r in want if r not in set(got)][:3]
        return len(got), f"{len(got)} rows, {len(want)} expected; extra {extra}; missing {missing}"
    return len(got), None


def main(folder: str, names: list[str]) -> int:
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "check")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names or list(QUERIES):
        started = time.perf_counter()
        try:
            df = QUERIES[name](spark, folder)
            rows = [tuple(r) for r in df.collect()]
            seconds = time.perf_counter() - started
            n, problem = compare(df.columns, rows, con, ORACLES[name]) if name in ORACLES else (len(rows), None)
        except Exception as error:
            n, problem = 0, f"{type(error).__name__}: {str(error)[:1500]}"
            seconds = time.perf_counter() - started
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:32s} {n:8d} rows {seconds:6.2f} s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
