"""Reusable DuckDB SQL fragments for the oracle twins (same fixed values as
the Spark expressions in :mod:`tokenloom.functions.text`)."""

from __future__ import annotations

from tokenloom.functions.keyed import sql_keyed_hash
from tokenloom.functions.text import JA_SCRIPT_CLASS, PY_WHITESPACE_CLASS

WS = PY_WHITESPACE_CLASS
NON_WS = "[^" + PY_WHITESPACE_CLASS[1:-1] + "]"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '\\A{WS}+', ''), '{WS}+\\z', '')"


def count_lit(x: str, d: str) -> str:
    return f"CAST((length({x}) - length(replace({x}, '{d}', ''))) / {len(d)} AS BIGINT)"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


def has_script(x: str) -> str:
    return f"regexp_matches({x}, '{JA_SCRIPT_CLASS}')"


def khash(seed, purpose, *keys) -> str:
    return sql_keyed_hash(seed, purpose, *keys)


def ints_str(x: str) -> str:
    """An int list rendered as 'a,b,c' (same as the Spark ``ints_str``)."""
    return f"array_to_string({x}, ',')"
