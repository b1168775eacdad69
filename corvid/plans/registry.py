"""Registry of the queries exposed through ``__spark_entry__``: each has a
Spark implementation over the driver tables and, where the result is
SQL-expressible, an independent DuckDB SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from corvid.plans import q_text, q_dense, q_sparse, q_logistic, q_factor, q_io  # noqa: F401
