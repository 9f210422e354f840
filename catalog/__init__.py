"""Registered queries: every operator on the shared test tables, with its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without `sql` only its rows are checked."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"Query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def load_all() -> None:
    from catalog import cleaning, evaluation, features, models, neighbours, profiling, rules, scoring, splitting  # noqa: F401
