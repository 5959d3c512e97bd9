"""Registry of named queries over the given tables, each with the SQL text that must give the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridledger.plans.roles import Catalogue, with_roles

Query = Callable[[Catalogue], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query; ``sql`` may name the derived sections as if they were tables."""

    def add(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = with_roles(sql)
        return fn

    return add


def _load() -> None:
    from gridledger.plans import files, grids, links, paths, requests, search, stored, tables, texts, volumes  # noqa: F401


def _runner(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(Catalogue(spark, folder))

    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: _runner(fn) for name, fn in _QUERIES.items()}


def all_oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
