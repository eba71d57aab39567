"""Registry of named queries: a Spark builder and, where SQL can express
it, an equivalent DuckDB/ANSI SQL string over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: ``@register("a6_rejoin", sql=...)`` on ``fn(spark, sf_dir)``."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (see ``spread_small`` for
    local sessions)."""
    from tokenloom.sources.corpus import spread_small

    return spread_small(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))
