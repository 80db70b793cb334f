"""Compare a Spark result with a DuckDB result, whatever the order of rows and columns."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def normalised(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda index: names[index])
    plain = [tuple(_plain(row[index]) for index in order) for row in rows]
    return [names[index] for index in order], sorted(plain, key=repr)


def spark_result(df) -> tuple[list[str], list[tuple]]:
    return normalised(df.columns, [tuple(row) for row in df.collect()])


def duckdb_result(connection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    return normalised([column[0] for column in cursor.description], cursor.fetchall())
