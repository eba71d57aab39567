"""Nested-key flattening and config merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty


def _leaves(dtype: Ty.DataType, path: list[str]):
    if isinstance(dtype, Ty.StructType):
        for f in dtype.fields:
            yield from _leaves(f.dataType, path + [f.name])
    else:
        yield path


def flatten_struct(df: DataFrame, col: str, keys=(), sep: str = ".", value_type: str = "string") -> DataFrame:
    """One row per leaf of a nested struct column: ``(keys..., key,
    value)`` with dotted key names (``a.b.c``) and values cast to one type.

    The leaf list comes from the schema (driver side, no data), the rows from
    one ``explode`` of an array of ``(key, value)`` structs."""
    dtype = df.schema[col].dataType
    entries = []
    for path in _leaves(dtype, []):
        c: Column = F.col(col)
        for p in path:
            c = c.getField(p)
        entries.append(F.struct(F.lit(sep.join(path)).alias("key"), c.cast(value_type).alias("value")))
    return df.select(*keys, F.explode(F.array(*entries)).alias("_kv")).select(*keys, "_kv.key", "_kv.value")


def merge_config(left, right) -> Column:
    """Config merge where the right side wins (``{**left, **right}``),
    without relying on the session's map-key dedup policy."""
    lc = F.col(left) if isinstance(left, str) else left
    rc = F.col(right) if isinstance(right, str) else right
    kept = F.map_filter(lc, lambda k, v: ~F.array_contains(F.map_keys(rc), k))
    return F.map_concat(kept, rc)


def render_map(col) -> Column:
    """A map rendered ``k1=v1;k2=v2`` in key order (stable for comparisons)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.array_sort(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
