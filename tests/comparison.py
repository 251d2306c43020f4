"""Comparing a Spark result with what DuckDB returns for the expected SQL."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def spark_rows(frame):
    return _sorted_rows(frame.columns, [tuple(row) for row in frame.collect()])


def duck_rows(connection, sql):
    relation = connection.sql(sql)
    return _sorted_rows(relation.columns, relation.fetchall())


def differences(frame, connection, sql):
    """Text on where the two results differ, or None if they are equal."""
    columns, rows = spark_rows(frame)
    expected_columns, expected = duck_rows(connection, sql)
    if columns != expected_columns:
        return f"columns {columns} instead of {expected_columns}"
    if rows == expected:
        return None
    missing = [row for row in expected if row not in set(rows)][:2]
    surplus = [row for row in rows if row not in set(expected)][:2]
    return f"{len(rows)} rows for {len(expected)}; missing {missing}; surplus {surplus}"
