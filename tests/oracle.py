"""Compare a query with its SQL: rows, column names and values, in any order."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, Decimal):
        return value.normalize()
    return value


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> tuple[int, str | None]:
    """The row count, and what differs (None if nothing does)."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return 0, f"columns {sorted(df.columns)} != {sorted(names)}"
    actual = _rows(df.columns, (tuple(r) for r in df.collect()))
    if actual == expected:
        return sum(actual.values()), None
    extra, missing = actual - expected, expected - actual
    return sum(actual.values()), (
        f"{sum(actual.values())} rows against {sum(expected.values())}; "
        f"only in Spark {list(extra)[:2]}; only in SQL {list(missing)[:2]}"
    )
