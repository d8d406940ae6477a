"""Compare Spark rows with DuckDB rows regardless of their order."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    for kind in (int, float, str, decimal.Decimal, dt.datetime, dt.date):
        if isinstance(value, kind):
            return kind.__name__
    return type(value).__name__


def _cell(value):
    if value is None:
        return ("", "")
    if isinstance(value, float) and math.isnan(value):
        return ("float", "nan")
    return (_kind(value), repr(value))


def spark_rows(df) -> tuple[list[str], list]:
    names = sorted(df.columns)
    rows = [tuple(_cell(row[name]) for name in names) for row in df.select(*names).collect()]
    return names, sorted(rows)


def duck_rows(connection, sql: str) -> tuple[list[str], list]:
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_cell(row[i]) for i in order) for row in result.fetchall()]
    return [columns[i] for i in order], sorted(rows)
