"""Runs registered queries in Spark and their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return f"{value:.9g}" if value != 0 else "0"
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return str(value)
    try:
        return f"{float(value):.9g}" if not isinstance(value, int) else str(value)
    except (TypeError, ValueError):
        return str(value)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows), sorted(columns)


def differences(spark_columns, spark_rows, con, sql):
    """None when equal, else a short text."""
    result = con.execute(sql)
    duck_columns = [d[0] for d in result.description]
    duck_types = dict(zip(duck_columns, [str(d[1]) for d in result.description]))
    duck_rows = result.fetchall()
    got, got_columns = normalised(spark_columns, spark_rows)
    want, want_columns = normalised(duck_columns, duck_rows)
    if got_columns != want_columns:
        return f"columns differ: spark {got_columns} sql {want_columns}"
    odd = [c for c, t in duck_types.items() if t.startswith(("DECIMAL", "HUGEINT", "TIMESTAMP"))]
    if odd:
        return f"sql types to cast: {[(c, duck_types[c]) for c in odd]}"
    if len(got) != len(want):
        extra = set(got) - set(want)
        lack = set(want) - set(got)
        return f"{len(got)} rows, sql {len(want)}; only spark {list(extra)[:2]}; only sql {list(lack)[:2]}"
    for a, b in zip(got, want):
        if a != b:
            return f"first difference: spark {a} sql {b} columns {got_columns}"
    return None
