"""Comparison of a Spark result with its SQL twin."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple("\0" if r[i] is None else str(r[i]) for i in order) for r in rows
    )


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both agree in columns and values, else a short account."""
    columns, got = _canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    expected_columns, expected = _canonical([d[0] for d in cursor.description], cursor.fetchall())
    if columns != expected_columns:
        return f"columns {columns} expected {expected_columns}"
    if got != expected:
        extra = list(set(got) - set(expected))[:3]
        missing = list(set(expected) - set(got))[:3]
        return f"{len(got)} rows, expected {len(expected)}; extra {extra}; missing {missing}"
    return None
