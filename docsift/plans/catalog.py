"""Query catalogue: every registered query as a Spark plan plus, where SQL
can state it, an independent DuckDB oracle over the same tables.

Each Spark query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the whole landed tables.  Output columns are scalars with fixed names and
types (integers as bigint, doubles rounded) so that both engines hash alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def _load_all() -> None:
    # importing the modules registers their queries
    from docsift.plans import (  # noqa: F401
        q_answer,
        q_chunks,
        q_embed,
        q_io,
        q_jobs,
        q_listing,
        q_retrieve,
        q_store,
    )


def _shipped(fn: QueryFn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from docsift.session import ship_package

        ship_package(spark)
        return fn(spark, sf_dir)

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, QueryFn]:
    """Registered queries; each first makes the package importable on the
    session's workers."""
    _load_all()
    return {name: _shipped(fn) for name, fn in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)
