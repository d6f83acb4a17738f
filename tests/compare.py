"""Spark result against DuckDB result: columns, row count and values, order-free."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or v != v:
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(int(v)) if math.isfinite(v) and v == int(v) else repr(v)
    if hasattr(v, "isoformat"):
        return str(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short account of the difference."""
    ours = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = rows_of(df.columns, ours), rows_of(names, theirs)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            n = sum(1 for p, q in zip(a, b) if p != q)
            return f"{n} rows differ, first {sorted(names)}: {x} != {y}"
    return None if a else "both empty"
