"""Registry of named queries: a Spark plan plus (optionally) oracle SQL.

``query(name, sql)`` registers ``fn(spark, root) -> DataFrame``.  Queries
whose result is not expressible in SQL (grouped-map kernels, writers)
register with ``sql=None`` and are checked by their own unit tests.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    # importing the plan modules fills the registry
    from . import (flagship, sql_ops, ingest_ops, quality_ops, forecast_ops,  # noqa: F401
                   product_ops, stream_ops, landing_ops)
