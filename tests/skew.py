"""Copies of the test tables in which one key holds a third of the rows."""

from __future__ import annotations

from pathlib import Path

import duckdb

import oracle

# A third of the rows, chosen by a hash of columns that stay as they are.
HOT = {
    "lineitem": "SELECT * REPLACE (CASE WHEN hash(l_partkey, l_linenumber, l_shipdate) % 3 = 0 "
    "THEN (SELECT min(o_orderkey) FROM orders WHERE o_orderpriority = '{priority}') "
    "ELSE l_orderkey END AS l_orderkey) FROM lineitem",
    "orders": "SELECT * REPLACE (CASE WHEN hash(o_orderkey) % 3 = 0 THEN 7 "
    "ELSE o_custkey END AS o_custkey) FROM orders",
    "events": "SELECT * REPLACE (CASE WHEN hash(event_id) % 3 = 0 THEN 7 "
    "ELSE user_id END AS user_id) FROM events",
}


def write_skewed(sf_dir: str, out_dir: str, priority: str = "2-HIGH") -> str:
    con: duckdb.DuckDBPyConnection = oracle.connect(sf_dir)
    for table in oracle.TABLES:
        rows = HOT.get(table, f"SELECT * FROM {table}").format(priority=priority)
        target = Path(out_dir) / f"{table}.parquet"
        con.execute(f"COPY ({rows}) TO '{target}' (FORMAT parquet, ROW_GROUP_SIZE 50000)")
    return out_dir
