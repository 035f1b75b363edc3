"""Run a query on Spark and its SQL on DuckDB and compare rows as multisets."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
from collections import Counter

import duckdb

# DuckDB's type names in Spark's spelling.
SAME_TYPE = {"integer": "int", "varchar": "string", "timestamp": "timestamp_ntz"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if isinstance(value, dt.datetime):
        return value.isoformat(timespec="microseconds")
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def kinds(pairs) -> dict[str, str]:
    return {name: SAME_TYPE.get(kind.lower(), kind.lower()) for name, kind in pairs}


def compare(result, con, text: str) -> tuple[int, list]:
    """Number of Spark rows, and the differences (empty if both sides agree)."""
    spark_rows = result.collect()
    answer = con.sql(text)
    differences = []
    left = kinds((f.name, f.dataType.simpleString()) for f in result.schema)
    right = kinds(zip(answer.columns, map(str, answer.types)))
    if left != right:
        differences.append(("schema", {k: (left.get(k), right.get(k)) for k in left.keys() | right.keys() if left.get(k) != right.get(k)}))
    if sorted(result.columns) == sorted(answer.columns):
        a, b = bag(result.columns, spark_rows), bag(answer.columns, answer.fetchall())
        differences += [("only spark", r, n) for r, n in list((a - b).items())[:3]]
        differences += [("only sql", r, n) for r, n in list((b - a).items())[:3]]
    return len(spark_rows), differences
