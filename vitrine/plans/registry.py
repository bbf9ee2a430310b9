"""Named queries with their DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        """Register a query; without `sql` only its rows are checked."""
        def add(fn: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = fn
            if sql is not None:
                self.oracles[name] = sql
            return fn
        return add


def r(expr: str, digits: int) -> str:
    """SQL twin of `functions.numeric.round_dec`."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"
