"""Exact dedup by a Golomb-coded fingerprint exchange.

Each source chunk sends every owner (a range of fingerprints) its sorted
fingerprints, Golomb-Rice coded; the owner answers with one duplicate bit per
fingerprint.  Only suspects have their text shuffled and compared whole.

Null text is an empty text; null doc_ids sort below all others; a repeated
row is a copy like any other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import LOWER, UPPER, id_text
from tokenloom.session import cut_lineage

FP_BITS = 62


def golomb_encode(values: np.ndarray, rice: int) -> bytes:
    """Gaps of sorted distinct values: quotient in unary, ``rice`` low bits."""
    gaps = np.diff(values.astype(np.int64), prepend=np.int64(0))
    quot, low = gaps >> rice, gaps & ((1 << rice) - 1)
    starts = np.concatenate(([0], np.cumsum(quot + 1 + rice)))
    bits = np.zeros(int(starts[-1]), np.uint8)
    bits[starts[:-1] + quot] = 1  # the unary part is zeros ended by a one
    for j in range(rice):
        bits[starts[:-1] + quot + 1 + j] = (low >> (rice - 1 - j)) & 1
    return np.packbits(bits).tobytes()


def golomb_decode(data: bytes, n: int, rice: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(data, np.uint8))
    ones = np.flatnonzero(bits)
    ends = np.empty(n, np.int64)
    at = 0
    for i in range(n):  # the end of each unary run is the first one at or after ``at``
        ends[i] = ones[np.searchsorted(ones, at)]
        at = ends[i] + 1 + rice
    starts = np.concatenate(([0], ends[:-1] + 1 + rice))[:n]
    low = np.zeros(n, np.int64)
    for j in range(rice):
        low = (low << 1) | bits[ends + 1 + j]
    return np.cumsum(((ends - starts) << rice) | low)


def _messages(owner_bits: int):
    span = FP_BITS - owner_bits

    def send(key, pdf: pd.DataFrame) -> pd.DataFrame:
        fps, counts = np.unique(pdf["fp"].to_numpy(np.int64), return_counts=True)
        owners, out = fps >> span, []
        for o in np.unique(owners):
            here = owners == o
            vals = fps[here] - (int(o) << span)
            rice = max(0, int(np.log2(max(1, (1 << span) // len(vals)))))
            out.append((key[0], int(o), len(vals), rice, golomb_encode(vals, rice), np.packbits(counts[here] > 1).tobytes()))
        return pd.DataFrame(out, columns=["src", "owner", "n", "rice", "coded", "own"])

    return send


def _answer(key, pdf: pd.DataFrame) -> pd.DataFrame:
    lists = [golomb_decode(c, n, r) for c, n, r in zip(pdf["coded"], pdf["n"], pdf["rice"])]
    vals, counts = np.unique(np.concatenate(lists), return_counts=True)
    out = []
    for src, own, mine in zip(pdf["src"], pdf["own"], lists):
        dup = counts[np.searchsorted(vals, mine)] > 1
        dup |= np.unpackbits(np.frombuffer(own, np.uint8), count=len(mine)).astype(bool)
        out.append((src, key[0], np.packbits(dup).tobytes()))
    return pd.DataFrame(out, columns=["src", "owner", "dup"])


def _mark(owner_bits: int):
    span = FP_BITS - owner_bits

    def mark(key, rows: pd.DataFrame, bitmaps: pd.DataFrame) -> pd.DataFrame:
        fps = np.unique(rows["fp"].to_numpy(np.int64))
        owners = fps >> span
        dup = np.zeros(len(fps), bool)
        for o, bits in zip(bitmaps["owner"], bitmaps["dup"]):
            here = np.flatnonzero(owners == o)
            dup[here] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(here)).astype(bool)
        return pd.DataFrame({"fp": fps[dup]})

    return mark


def suspects(prints: DataFrame, chunks: int, owner_bits: int) -> DataFrame:
    """``fp`` of every fingerprint that more than one row holds (once per chunk
    that holds it).  ``prints`` has src and fp."""
    rows = prints.select("src", "fp")
    sent = rows.groupBy("src").applyInPandas(_messages(owner_bits), "src int, owner long, n int, rice int, coded binary, own binary")
    answers = sent.groupBy("owner").applyInPandas(_answer, "src int, owner long, dup binary")
    return rows.groupBy("src").cogroup(answers.groupBy("src")).applyInPandas(_mark(owner_bits), "fp long")


def exact_dedup(docs: DataFrame, rows_per_chunk: int = 100_000) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z.  The largest doc_id
    of a group stays; of rows that repeat that id, all are marked kept.
    """
    base = id_text(docs).withColumn("norm", F.translate("text", UPPER, LOWER)).drop("text")
    prints = cut_lineage(
        base.select(
            "doc_id",
            F.sha2("norm", 256).alias("text_sha256"),
            F.shiftrightunsigned(F.xxhash64("norm"), 64 - FP_BITS).alias("fp"),
        ),
        "exact-prints",
    )
    n = prints.count()
    chunks = max(8, -(-n // rows_per_chunk))
    owner_bits = max(3, (chunks - 1).bit_length())
    # Dealt by id and by a few salts, so that a repeated id or null ids do not fill a chunk.
    prints = prints.withColumn("src", F.pmod(F.xxhash64("doc_id", F.lit(7), F.substring("text_sha256", 1, 4)), F.lit(chunks)).cast("int"))
    found = cut_lineage(suspects(prints, chunks, owner_bits).distinct(), "exact-suspects")
    if found.isEmpty():
        return prints.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    # Bytes are compared by grouping on the whole text; equal copies fold in each map task.
    groups = cut_lineage(
        base.withColumn("fp", F.shiftrightunsigned(F.xxhash64("norm"), 64 - FP_BITS))
        .join(found, "fp", "left_semi")
        .groupBy("norm")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select(F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size"),
        "exact-groups",
    )
    return (
        prints.join(groups, "text_sha256", "left")
        .select(
            "doc_id",
            F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            "text_sha256",
        )
        .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    )


ORACLE_SQL = f"""
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM n
"""
