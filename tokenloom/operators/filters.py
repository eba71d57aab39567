"""Projections, filters and predicates (F1-F9, UD1).

All are narrow transformations (no shuffle).  Catalyst prunes unused columns
into the parquet ``ReadSchema``; ``length``/``rlike`` predicates cannot use
parquet statistics and run right after the scan in the same codegen stage.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tokenloom.functions import text as T


def drop_blank(df: DataFrame, col: str = "text") -> DataFrame:
    """keep records whose text has a non-white-space character."""
    return df.filter(T.has_non_space(col))


def strip_text(df: DataFrame, col: str = "text", out: str | None = None) -> DataFrame:
    """Python ``str.strip()`` of the text (Unicode white space)."""
    return df.withColumn(out or col, T.strip(col))


def min_length(df: DataFrame, col: str = "text", threshold: int = 100) -> DataFrame:
    """code points strictly greater than ``threshold``."""
    return df.filter(T.char_len(col) > F.lit(threshold))


def min_delims(df: DataFrame, col: str = "text", delim: str = T.JA_COUNT_DELIM, threshold: int = 2) -> DataFrame:
    """occurrences of the sentence mark strictly greater than ``threshold``."""
    return df.filter(T.count_literal(col, delim) > F.lit(threshold))


def quality_predicate(col: str = "text", min_chars: int = 100, count_delim: str = T.JA_COUNT_DELIM, min_marks: int = 2) -> Column:
    """F3 and F4 as one predicate: ``len(t) > 100 and t.count(mark) > 2``."""
    return (T.char_len(col) > F.lit(min_chars)) & (T.count_literal(col, count_delim) > F.lit(min_marks))


def default_field(df: DataFrame, col: str, default: str = "") -> DataFrame:
    """an absent column or a null value becomes ``default``."""
    if col in df.columns:
        return df.withColumn(col, F.coalesce(F.col(col), F.lit(default)))
    return df.withColumn(col, F.lit(default))


def has_script(df: DataFrame, cols, char_class: str = T.JA_SCRIPT_CLASS) -> DataFrame:
    """keep rows where the concatenated fields contain a code point of the
    class (kana or CJK by default); absent/null fields count as empty."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    parts = [F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("") for c in cols]
    return df.filter(T.has_script(F.concat(*parts), char_class))


def project(df: DataFrame, keep) -> DataFrame:
    """keep only the named columns (column pruning reaches the scan)."""
    return df.select(*keep)


def drop_cols(df: DataFrame, cols) -> DataFrame:
    """remove source columns after a mapping."""
    return df.drop(*cols)


def text_size(df: DataFrame, col: str = "text") -> DataFrame:
    """F8: code-point and UTF-8 byte sizes."""
    return df.withColumn("n_codepoints", T.char_len(col)).withColumn("n_bytes", T.byte_len(col))


def filter_rows(df: DataFrame, predicate: Column, observation: Observation | None = None) -> DataFrame:
    """F9 / UD1: filter by a Column predicate; with an ``Observation`` the
    surviving row count is reported when the job runs (no extra pass)."""
    out = df.filter(predicate)
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    return out


def filter_udf(df: DataFrame, fn, cols) -> DataFrame:
    """UD1 for the caller's own Python predicate (slow path: Arrow batches).

    ``fn`` takes pandas Series (one per column in ``cols``) and returns a
    boolean Series.  Prefer a Column predicate with :func:`filter_rows`."""
    names = list(cols)

    @F.pandas_udf("boolean")
    def _pred(batch: pd.DataFrame) -> pd.Series:
        return fn(*[batch[c] for c in names]).astype(bool)

    return df.filter(_pred(F.struct(*[F.col(c) for c in names])))
