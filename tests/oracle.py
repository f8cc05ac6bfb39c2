"""Compare a query with its oracle, both read as plain rows."""

from __future__ import annotations

import math
from datetime import date, datetime
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}") + 0.0
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return float(value)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    """None when equal, else a short account of the difference."""
    df = fn(spark, sf_dir)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    want = con.execute(sql)
    want_cols, expected = [d[0] for d in want.description], want.fetchall()
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    a, b = rows_of(got_cols, got), rows_of(want_cols, expected)
    if a == b:
        return None
    only_a = [r for r in a if r not in set(b)][:3]
    only_b = [r for r in b if r not in set(a)][:3]
    return f"{len(a)} rows, expected {len(b)}; only here {only_a}; only expected {only_b}"
