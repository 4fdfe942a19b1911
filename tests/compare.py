"""Comparing a Spark result with DuckDB's, without regard to row order."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        file = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return connection


def canonical(frame) -> list[tuple]:
    """Rows as comparable tuples, columns by name; doubles keep all their digits."""
    frame = frame[sorted(frame.columns)]
    rows = []
    for row in frame.itertuples(index=False, name=None):
        rows.append(tuple(_plain(value) for value in row))
    return sorted(rows)


def _plain(value) -> str:
    if pd.isna(value):
        return "NULL"
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return str(bool(value))
    if hasattr(value, "isoformat"):
        return value.isoformat()[:10]
    if isinstance(value, str):
        return value
    return repr(float(value))
