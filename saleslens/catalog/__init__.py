"""Registry of the operator inventory: one Spark query and one DuckDB oracle per key.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
tables in ``sf_dir``; its oracle is SQL over the same raw tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


def load_all() -> None:
    from saleslens.catalog import (core, pipelines, quality, insights, streams, storage)  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLES)
