"""Where the modules of this subpackage enter their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query, with DuckDB SQL for the same rows where SQL can say it."""

    def enter(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return enter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table of the given folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
