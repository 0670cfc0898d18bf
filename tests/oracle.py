"""Runs a query on Spark and its SQL on DuckDB and compares the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.isdir(path):
            path += "/*.parquet"
        if os.path.exists(path) or path.endswith("*.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(plain(row[i]) for i in order)) for row in rows)


def compare(spark, con, query, sql, sf_dir) -> str | None:
    """None when both sides agree, else what differs."""
    df = query(spark, sf_dir)
    spark_rows = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    sql_rows = sorted_rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns: {sorted(df.columns)} against {sorted(names)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows: {len(spark_rows)} against {len(sql_rows)}; {spark_rows[:1]} against {sql_rows[:1]}"
    wrong = [(a, b) for a, b in zip(spark_rows, sql_rows) if a != b]
    return f"{len(wrong)} rows differ, first: {wrong[0]}" if wrong else None
