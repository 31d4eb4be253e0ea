"""Order-insensitive comparison of a Spark query with its DuckDB statement."""

from __future__ import annotations

import glob
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def spark_rows(df):
    return _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(connection, sql):
    cursor = connection.execute(sql)
    return _sorted_rows([c[0] for c in cursor.description], cursor.fetchall())
