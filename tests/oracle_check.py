"""Compare query results with DuckDB: row count, column names, and every value."""

from __future__ import annotations

import datetime
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        raise TypeError("a decimal in the result; use bigint or double")
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return (type(value).__name__, repr(value))


def spark_rows(frame):
    columns = sorted(frame.columns)
    rows = frame.select(*columns).collect()
    return columns, sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


def duck_rows(connection, statement):
    cursor = connection.execute(statement)
    names = [d[0] for d in cursor.description]
    columns = sorted(names)
    order = [names.index(c) for c in columns]
    rows = cursor.fetchall()
    return columns, sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(frame, connection, statement) -> str | None:
    """Description of the first difference, or None when the results are identical."""
    ours, theirs = spark_rows(frame), duck_rows(connection, statement)
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows / {len(theirs[1])} rows"
    for mine, other in zip(ours[1], theirs[1]):
        if mine != other:
            return f"{ours[0]}: {mine} / {other}"
    return None
