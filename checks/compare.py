"""Runs queries beside their SQL and compares rows, columns and values: ``python -m checks.compare [sf_dir] [name …]``."""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb

from checks.registry import ORACLE, QUERIES
from corpus_engine.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def cell(value) -> str:
    if value is None:
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "∅" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, int):
        return str(value)
    return str(value)


def normal(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf: str, name: str) -> str:
    """Empty when equal, else what differs."""
    got = QUERIES[name](spark, sf)
    got_rows = normal(got.columns, got.collect())
    if name not in ORACLE:
        return "" if got_rows else "no rows"
    cursor = con.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    want_rows = normal(columns, cursor.fetchall())
    if sorted(columns) != sorted(got.columns):
        return f"columns {sorted(got.columns)} != {sorted(columns)}"
    if len(got_rows) != len(want_rows):
        return f"{len(got_rows)} rows != {len(want_rows)}"
    wrong = [(g, w) for g, w in zip(got_rows, want_rows) if g != w]
    return f"{len(wrong)} rows differ, first {sorted(columns)}:\n  {wrong[0][0]}\n  {wrong[0][1]}" if wrong else ""


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf), 0
    for name in argv[1:] or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, con, sf, name)
        except Exception:
            problem = traceback.format_exc()[-2500:]
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
