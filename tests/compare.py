"""Compare registered queries with their SQL counterparts in DuckDB, order apart."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows_by_name(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def differences(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal, otherwise what differs."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_by_name(names, result.fetchall())
    got = rows_by_name(frame.columns, frame.collect())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} instead of {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(want)} rows differ, first: {wrong[0]}" if wrong else None
