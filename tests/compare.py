"""Compare registered queries with their SQL in DuckDB, as sets of rows."""

from __future__ import annotations

import glob
import os
from collections import Counter
from datetime import datetime

import duckdb

import __spark_entry__ as entry


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in data)


def both(spark, name: str, folder: str):
    frame = entry.queries()[name](spark, folder)
    ours = rows(frame.columns, frame.collect())
    result = oracle(folder).execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    theirs = rows(columns, result.fetchall())
    return sorted(frame.columns), ours, sorted(columns), theirs
