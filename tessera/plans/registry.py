"""Registry of named queries: key -> (spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in _QUERIES:
            raise KeyError(f"duplicate query key {key!r}")
        _QUERIES[key] = fn
        if sql is not None:
            _ORACLES[key] = sql.strip()
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)


def _load_all() -> None:
    # Importing the plan modules fills the registry.
    from tessera.plans import (  # noqa: F401
        charges,
        companies,
        employees,
        finance,
        finances_csv,
        job_queries,
        people,
        products,
        scholarship,
        text_udfs,
        transactions,
    )
