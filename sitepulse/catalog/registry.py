"""Name -> query, and name -> SQL giving the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if check is not None:
            CHECKS[name] = check
        return fn

    return register


def minutes(start: str, end: str) -> str:
    """Whole minutes between two times, floored."""
    return f"cast(floor((epoch_us({end}) - epoch_us({start})) / 60000000.0) as bigint)"
