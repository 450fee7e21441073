"""Row-by-row comparison of a Spark result with its SQL counterpart."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return ("nan",)
    return (type(value).__name__, str(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted(tuple(_cell(row[n]) for n in order) for row in rows)


def mismatch(df, connection, sql) -> str | None:
    result = connection.execute(sql)
    columns = [item[0] for item in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    kinds = {item[0]: str(item[1]) for item in result.description}
    known = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
        "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
    }
    for name, kind in df.dtypes:
        if known.get(kind) != kinds[name]:
            return f"column {name} is {kind} instead of {kinds[name]}"
    ours = _rows(df.columns, [tuple(row) for row in df.collect()])
    theirs = _rows(columns, expected)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows instead of {len(theirs)}"
    different = [pair for pair in zip(ours, theirs) if pair[0] != pair[1]]
    return f"{len(different)} rows differ, first {different[0]}" if different else None
