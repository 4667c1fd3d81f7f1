"""Query name -> (Spark query, equivalent SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

CATALOG: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(run: Query) -> Query:
        if run.__name__ in CATALOG:
            raise ValueError(f"query {run.__name__} is registered twice")
        CATALOG[run.__name__] = (run, sql)
        return run

    return register
