"""Compare a named query with its SQL twin."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _normal(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(value)
    if hasattr(value, "item"):
        return value.item()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_normal(r[i]) for i in order) for r in rows]
    return sorted(table, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(df, con: duckdb.DuckDBPyConnection, sql: str, tolerance: float = 0.0) -> list[str]:
    """Differences between both results, at most a handful; empty when equal."""
    result = con.execute(sql)
    expected_cols = [d[0] for d in result.description]
    expected = _rows(expected_cols, result.fetchall())
    if sorted(df.columns) != sorted(expected_cols):
        return [f"columns {sorted(df.columns)} != {sorted(expected_cols)}"]
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(actual) != len(expected):
        return [f"{len(actual)} rows, expected {len(expected)}", f"got {actual[:2]}", f"want {expected[:2]}"]
    problems = []
    for got, want in zip(actual, expected):
        same = all(
            g == w or (isinstance(g, float) and isinstance(w, float) and abs(g - w) <= tolerance)
            for g, w in zip(got, want)
        )
        if not same:
            problems.append(f"{got} != {want}")
            if len(problems) == 3:
                break
    return problems
