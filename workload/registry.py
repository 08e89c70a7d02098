"""Registry of named queries: a Spark function and, where possible, the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: QueryFunction
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register the decorated function; ``covers`` lists inventory ids."""

    def register(function: QueryFunction) -> QueryFunction:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, tuple(covers.split()), function, sql)
        return function

    return register
