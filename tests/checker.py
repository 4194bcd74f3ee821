"""Run a query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

from parcelflow.catalog import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.10g}") + 0.0
    return value


def _ordered(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr), sorted(columns)


def compare(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    result = connection.execute(sql)
    wanted, wanted_columns = _ordered(result.fetchall(), [c[0] for c in result.description])
    found, found_columns = _ordered([tuple(r) for r in df.collect()], df.columns)
    if wanted_columns != found_columns:
        return f"columns {found_columns} against {wanted_columns}"
    if len(wanted) != len(found):
        return f"{len(found)} rows against {len(wanted)}"
    different = [(f, w) for f, w in zip(found, wanted) if f != w]
    return f"{len(different)} rows differ, first {different[0]}" if different else None
