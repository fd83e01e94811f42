"""Named queries over the input tables and the SQL each one must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, query: Query, sql: str | None = None) -> None:
    """Add one query; a name is used once."""
    if name in _QUERIES:
        raise ValueError(f"query {name} is registered twice")
    _QUERIES[name] = query
    if sql is not None:
        _ORACLES[name] = sql


def _load() -> None:
    if not _QUERIES:
        from tapeloom.plans import catalog

        catalog.register_all(register)


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
