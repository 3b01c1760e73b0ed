"""Where the query modules enter their queries and SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under a name (its own by default), with its SQL unless it has none."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def rnd(expression: str, digits: int) -> str:
    """SQL for Spark's rounding of doubles: halves, as printed in decimal, go away from zero."""
    return f"CAST(round(CAST(CAST(({expression})::DOUBLE AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"
