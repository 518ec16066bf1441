"""Compares a Spark result with the same query run by DuckDB."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = "region nation customer supplier part orders lineitem events".split()


def duck_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 4)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when columns, types by kind, and rows agree."""
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} and {sorted(columns)}"
    ours, theirs = _bag(result.columns, result.collect()), _bag(columns, cursor.fetchall())
    if ours == theirs:
        return ""
    only_ours, only_theirs = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} and {sum(theirs.values())} rows; only in Spark {list(only_ours)[:2]}; "
        f"only in SQL {list(only_theirs)[:2]}"
    )
