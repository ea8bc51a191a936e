"""Comparison of a Spark result with its SQL counterpart in DuckDB."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, sql: str, connection: duckdb.DuckDBPyConnection) -> str | None:
    """What differs, or ``None``. Rows are compared as a multiset, columns by name."""
    relation = connection.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    kinds = {name: str(kind) for name, kind in zip(relation.columns, relation.types, strict=True)}
    names = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
             "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "DATE": "date"}
    for field in df.schema:
        if names.get(kinds[field.name]) != field.dataType.simpleString():
            return f"{field.name}: {field.dataType.simpleString()} != {kinds[field.name]}"
    mine = _rows(df.columns, df.collect())
    theirs = _rows(relation.columns, relation.fetchall())
    if mine == theirs:
        return None
    return (
        f"{sum(mine.values())} rows against {sum(theirs.values())}; only in Spark "
        f"{list((mine - theirs).items())[:3]}; only in SQL {list((theirs - mine).items())[:3]}"
    )
