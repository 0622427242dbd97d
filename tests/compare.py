"""Compare a Spark result with its SQL check on DuckDB."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows(names, tuples) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(_plain(r[i])).__name__, _plain(r[i])) for i in order) for r in tuples)


def differences(df, sql: str, connection) -> str | None:
    """What differs, or nothing."""
    spark_rows = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    sql_rows = rows(names, cursor.fetchall())
    if spark_rows == sql_rows:
        return None
    more, less = spark_rows - sql_rows, sql_rows - spark_rows
    return (
        f"{sum(spark_rows.values())} rows, check {sum(sql_rows.values())}; "
        f"only Spark {sum(more.values())} e.g. {next(iter(more), None)}; "
        f"only check {sum(less.values())} e.g. {next(iter(less), None)}"
    )
