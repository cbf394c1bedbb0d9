"""Named queries over the supplied tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} exists already")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load() -> None:
    """Import every module that registers queries."""
    from tapewright.catalogue import (  # noqa: F401
        counts, coverage, ingest, loads, merges, pages, runs, scalars, search, series, streams, texts, ticks,
    )
