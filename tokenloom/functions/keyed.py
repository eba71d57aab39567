"""Keyed, repeatable randomness.

Spark's ``rand()`` / ``shuffle()`` / ``uuid()`` are nondeterministic: they
block predicate pushdown and redraw when a task is retried.  Every random
decision in tokenloom is instead a hash of ``(seed, purpose, row keys...)``:

    h = first 8 hex digits of md5("seed|key1|key2...")  ->  uniform on [0, 2^32)

The same value is computable in any SQL engine with ``md5`` (the DuckDB twin
is ``('0x' || substr(md5(...), 1, 8))::BIGINT``), which is what lets the
oracle check seeded operators row for row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _as_col(k) -> Column:
    if isinstance(k, Column):
        return k.cast("string")
    if isinstance(k, str):
        return F.col(k).cast("string")
    return F.lit(str(k))


def seed_tag(seed, purpose: str) -> str:
    """The leading hash field: ``"<seed>:<purpose>"`` keeps draws for different
    purposes (drop, shuffle, split, ...) independent under one seed."""
    return f"{seed}:{purpose}"


def keyed_hash(seed, purpose: str, *keys) -> Column:
    """Integer hash uniform on [0, 2^32) of the seed, a purpose tag and keys.

    ``keys`` are column names, Columns (cast to string) or literals.  Keys
    must be integers or strings so every engine renders them identically.
    """
    parts = [F.lit(seed_tag(seed, purpose))] + [_as_col(k) for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("bigint")


def keyed_uniform(seed, purpose: str, *keys) -> Column:
    """``keyed_hash / 2^32``: a double uniform on [0, 1); exact in binary."""
    return keyed_hash(seed, purpose, *keys) / F.lit(TWO_POW_32)


def sql_keyed_hash(seed, purpose: str, *key_sql: str) -> str:
    """DuckDB/ANSI twin of :func:`keyed_hash` for oracle SQL strings."""
    inner = " || '|' || ".join([f"'{seed_tag(seed, purpose)}'"] + [f"CAST({k} AS VARCHAR)" for k in key_sql])
    return f"CAST(('0x' || substr(md5({inner}), 1, 8)) AS BIGINT)"
