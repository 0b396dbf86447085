"""

``@register(key, sql=...)`` records the Spark builder ``(spark, sf_dir) -> DataFrame``
and, when the job is SQL-expressible, the DuckDB oracle text for the same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def wrap(fn: QueryFn) -> QueryFn:
        if key in _QUERIES:
            raise ValueError(f"duplicate query key {key!r}")
        _QUERIES[key] = fn
        if sql is not None:
            _ORACLES[key] = sql.strip()
        return fn
    return wrap


def _load() -> None:
    # Importing the modules fills the registry.
    from tidemill.plans import (  # noqa: F401
        q_bom, q_clients, q_configs, q_features, q_logs, q_messages, q_streams, q_tenants,
    )


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
