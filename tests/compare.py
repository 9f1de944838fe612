"""Comparison of a Spark result with the SQL twin on the same tables."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if glob.glob(os.path.join(folder, f"{name}.parquet")):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(value) + 0.0
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql) -> list[str]:
    """What differs between both results; empty when they agree."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    expected = found.fetchall()
    actual = df.collect()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} instead of {sorted(names)}"]
    problems = []
    if len(actual) != len(expected):
        problems.append(f"{len(actual)} rows instead of {len(expected)}")
    ours, theirs = rows_of(df.columns, actual), rows_of(names, expected)
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} of {len(theirs)} rows differ, columns {sorted(names)}: {wrong[:3]}")
    return problems
