"""Compare a Spark result with DuckDB's on the same files, whatever the row order."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

#: The folders of test tables.
TESTDATA = Path("/root/testdata")


def duckdb_over(folder: str):
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, connection, sql: str) -> str | None:
    """None when both have the same columns and rows, else what differs."""
    result = connection.execute(sql)
    names, expected = _table([c[0] for c in result.description], result.fetchall())
    found_names, found = _table(df.columns, [tuple(r) for r in df.collect()])
    if names != found_names:
        return f"columns {found_names} instead of {names}"
    if len(found) != len(expected):
        return f"{len(found)} rows instead of {len(expected)}"
    wrong = [(f, e) for f, e in zip(found, expected, strict=True) if f != e]
    if wrong:
        found_row, expected_row = wrong[0]
        cells = [(n, f, e) for n, f, e in zip(names, found_row, expected_row, strict=True) if f != e]
        return f"{len(wrong)} rows differ, the first in {cells[:5]}"
    return None
