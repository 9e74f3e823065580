"""Compare a Spark result with DuckDB's answer to the query's oracle."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(row[i] for i in order) for row in rows), key=repr
    )


def duckdb_rows(connection, sql):
    cursor = connection.execute(sql)
    return _sorted_rows([d[0] for d in cursor.description], cursor.fetchall())


def spark_rows(df):
    return _sorted_rows(df.columns, [tuple(row) for row in df.collect()])
