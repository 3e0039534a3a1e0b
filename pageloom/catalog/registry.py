"""Where the catalog modules enter their queries and the SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with DuckDB SQL for the same rows where SQL can say it."""

    def enter(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return enter


def with_inputs(body: str, **texts: str) -> str:
    """SQL with the named input texts as common table expressions."""
    parts = ", ".join(f"{name} AS ({text.strip()})" for name, text in texts.items())
    return f"WITH {parts} {body}"
