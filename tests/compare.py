"""Compare a Spark result with DuckDB's, regardless of row order."""

from __future__ import annotations

import datetime as dt
import decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    values = [tuple(plain(row[i]) for i in order) for row in rows]
    return names, sorted(values, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(connection, sql):
    cursor = connection.execute(sql)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())
