"""The registered queries, each with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelwright.plans.fixtures import SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, recursive: bool = False) -> Callable[[Query], Query]:
    """Register a query under its function's name; ``sql`` may use the panels of the fixtures."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            head, body = ("", sql) if not sql.lstrip().startswith("+") else (",", sql.lstrip()[1:])
            ORACLES[f.__name__] = f"WITH {'RECURSIVE ' if recursive else ''}{SQL}{head}{body}"
        return f

    return put
