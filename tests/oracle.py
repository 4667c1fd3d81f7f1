"""Run a catalog query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def compare(spark_df, con, sql: str) -> str | None:
    """None when both sides hold the same rows; otherwise what differs."""
    columns = sorted(spark_df.columns)
    result = con.execute(sql)
    sql_columns = [d[0] for d in result.description]
    if sorted(sql_columns) != columns:
        return f"columns {columns} != {sorted(sql_columns)}"
    order = [sql_columns.index(c) for c in columns]
    expected = sorted(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    actual = sorted(tuple(_plain(v) for v in row) for row in spark_df.select(*[f"`{c}`" for c in columns]).collect())
    if len(expected) != len(actual):
        return f"rows {len(actual)} != {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"row {a} != {e}"
    return None
