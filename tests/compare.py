"""Order-free comparison of a Spark result with DuckDB's answer over the same files."""

from __future__ import annotations

import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        table = name.removesuffix(".parquet")
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{name}')")
    return con


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def _canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(row[i]) for i in order) for row in rows), key=repr)


def difference(frame, con, sql: str) -> str | None:
    """None if both agree, else what differs."""
    answer = con.execute(sql)
    names = [column[0] for column in answer.description]
    expected = answer.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    got = _canonical(frame.columns, [tuple(row) for row in frame.collect()])
    want = _canonical(names, expected)
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for left, right in zip(got, want):
        if left != right or [type(v) for v in left] != [type(v) for v in right]:
            return f"{sorted(names)}: {left} against {right}"
    return None
