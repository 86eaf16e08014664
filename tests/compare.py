"""Order-insensitive comparison of a Spark result with the result of its SQL statement."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return con


def _cell(value: object) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "NULL"
    if isinstance(value, decimal.Decimal):
        return f"{value.normalize():f}" if value else "0"
    if isinstance(value, float):
        return repr(round(value, 9))
    if isinstance(value, dt.datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return str(value)


def normal(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_rows, spark_columns: list[str], con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both agree, else a short account of how they differ."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(spark_columns):
        return f"columns {sorted(spark_columns)} against {sorted(columns)}"
    got = normal(spark_columns, [tuple(r) for r in spark_rows])
    want = normal(columns, result.fetchall())
    if got == want:
        return None
    only_got = sorted(set(got) - set(want))[:2]
    only_want = sorted(set(want) - set(got))[:2]
    return f"{len(got)} rows against {len(want)}; columns {sorted(columns)}\n only Spark: {only_got}\n only SQL:   {only_want}"
