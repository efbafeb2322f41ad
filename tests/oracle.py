"""Side-by-side runs of registered queries and their SQL."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import duckdb

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in BASE:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.date() if value.time() == dt.time() else value
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_rows(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), _rows(df.columns, df.collect())


def sql_rows(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    return sorted(columns), _rows(columns, result.fetchall())
