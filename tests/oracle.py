"""Run a registered query and its SQL side by side and compare the rows."""

from __future__ import annotations

import math
import os
from glob import glob

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def normal(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(normal(r[i]) for i in order) for r in records]
    return sorted(rows, key=lambda row: tuple((v is not None, str(v)) for v in row))


def compare(df, con, sql) -> str | None:
    """None when equal, else what differs."""
    got = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}: {got[:2]} / {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, e.g. {bad[0]}" if bad else None
