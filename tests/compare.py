"""Run named queries in Spark and their check texts in DuckDB on the same files."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def open_duckdb(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def duckdb_rows(connection, sql):
    result = connection.execute(sql)
    return sorted_rows([d[0] for d in result.description], result.fetchall())


def spark_rows(df):
    return sorted_rows(df.columns, [tuple(row) for row in df.collect()])


def difference(expected, actual) -> str | None:
    """None when equal (floats exactly), else a short account."""
    if expected[0] != actual[0]:
        return f"columns {expected[0]} != {actual[0]}"
    if len(expected[1]) != len(actual[1]):
        return f"rows {len(expected[1])} != {len(actual[1])}"
    wrong = [(a, b) for a, b in zip(expected[1], actual[1]) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
