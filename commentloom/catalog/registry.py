"""Named queries over the test tables, each with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def load() -> None:
    """Import every module that registers queries."""
    from commentloom.catalog import (  # noqa: F401
        flow_queries,
        label_queries,
        report_queries,
        row_queries,
        source_queries,
        text_queries,
    )
