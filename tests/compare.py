"""Compare a registered query with its SQL in DuckDB, ignoring the order of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def sql_result(sql: str, sf_dir: str):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    types = [str(d[1]) for d in cursor.description]
    return columns, types, cursor.fetchall()


def differences(frame, sql: str, sf_dir: str) -> str:
    """Empty if both give the same bag of rows under the same column names."""
    columns, types, rows = sql_result(sql, sf_dir)
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    expected = _bag(columns, rows)
    got = _bag(frame.columns, [tuple(r) for r in frame.collect()])
    if got != expected:
        return (
            f"{sum(got.values())} rows, expected {sum(expected.values())};"
            f" only here {list((got - expected).items())[:3]},"
            f" only in SQL {list((expected - got).items())[:3]}"
        )
    names = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER",
             "boolean": "BOOLEAN"}
    here = {name: names.get(kind, kind) for name, kind in frame.dtypes}
    wrong = {c: (here[c], t) for c, t in zip(columns, types) if here[c] != t}
    return f"types {wrong}" if wrong else ""
