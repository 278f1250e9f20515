"""Collects the queries of the catalog modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its equivalent on the same tables."""

    def add(function: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query '{name}' is registered twice")
        _queries[name] = function
        if sql is not None:
            _sql[name] = sql
        return function

    return add


def _load() -> None:
    from tabweave.catalog import evaluation, history, network, preparation, sparse  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
