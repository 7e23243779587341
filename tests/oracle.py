"""Run registered queries on Spark and their SQL on DuckDB, and compare the rows.

    python tests/oracle.py [sf-dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return "0" if v == 0 else f"{v:.9g}"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return "null" if v is None else str(v)


def _rows(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in at) for r in rows)


def compare(spark, con, query, sql: str, sf: str) -> str | None:
    """``None`` if the rows agree, else what differs."""
    df = query(spark, sf)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = _rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}; e.g. {sorted(set(ours) ^ set(theirs))[:4]}"
    off = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(off)} of {len(ours)} rows differ, e.g. {off[:2]}" if off else None


def main() -> int:
    import __spark_entry__ as entry
    from marketlens.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = get_session("oracle", "local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in wanted or queries:
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, queries[name], oracles[name], sf)
                note = ""
            else:
                n = len(queries[name](spark, sf).collect())
                problem, note = (None if n else "no rows"), f" (rows only: {n})"
        except Exception as e:  # report and go on to the next query
            problem, note = f"{type(e).__name__}: {str(e)[:600]}", ""
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:24s} {time.time() - start:6.2f}s{note} {problem or ''}"[:1200], flush=True)
    print(f"{bad} failed", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
