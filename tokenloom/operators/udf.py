"""User-defined function surface (UD1-UD3) for the caller's own Python.

Built-in Column expressions are always preferred; these wrap caller code in
Arrow-batched pandas functions (never row-at-a-time Python UDFs).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

PIECE_ROWS = 256  # rows that the caller's function gets at once


def _pieces(batches: Iterator[pd.DataFrame], key: str | None = None) -> Iterator[pd.DataFrame]:
    """The batches in pieces of at most ``PIECE_ROWS`` rows (with ``key``: all
    of a batch's rows of that many keys): what the caller's function makes of a
    piece (copies of its texts, a row for each word) is gone before the next
    one, however many rows an Arrow batch holds."""
    for b in batches:
        at = pd.factorize(b[key], use_na_sentinel=False)[0] if key else np.arange(len(b))
        order = np.argsort(at, kind="stable")
        cuts = np.searchsorted(at[order], np.arange(PIECE_ROWS, len(b), PIECE_ROWS))
        for rows in np.split(order, cuts):
            if len(rows):
                yield b.take(rows).reset_index(drop=True)


def map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """UD2: row mapper; ``fn`` maps a piece of a pandas batch to the same
    rows with the output columns (source columns replaced).  Narrow."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _pieces(batches):
            yield fn(b)

    return df.mapInPandas(run, schema)


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, workers: int | None = None,
                key: str | None = None) -> DataFrame:
    """UD3: batched mapper, n rows in -> m rows out per piece of a batch.  ``workers``
    re-partitions first (``num_proc`` of the reference), by ``key`` when
    given so related rows stay in one task; a piece holds all rows that its
    batch has of a key."""
    if workers:
        df = df.repartition(workers, key) if key else df.repartition(workers)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _pieces(batches, key):
            out = fn(b)
            if len(out):
                yield out

    return df.mapInPandas(run, schema)
