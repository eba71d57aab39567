"""Helpers shared by the corpus operators: inputs, words, hashes."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
SLOTS_A_BLOCK = 1 << 14  # 64-bit words of a bitmap that one row brings to the driver


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """doc_id and text (null: empty) only, so extra columns cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def map_rows(rows: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInPandas`` for rows with a doc_id that ``fn`` passes on: it goes
    through Python as text, as a long column with a null in it would come as
    doubles and lose the last bits of large ids."""
    out = rows.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(fn, schema.replace("doc_id long", "doc_id string"))
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def doc_key():
    """``th``: with doc_id it identifies a document.  Rows that repeat both
    are one document for every count, and each gets the same result."""
    return F.xxhash64("text").alias("th")


def text_hashes(col):
    """``h1``, ``h2``: 128 bits that tell texts apart."""
    return F.xxhash64(col).alias("h1"), F.xxhash64(F.lit(1), col).alias("h2")


def id_crc():
    """crc32 of the id as text (null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))


def words(text: str, lower: bool = False) -> list[bytes]:
    """Runs of anything but the six ASCII spaces; lower-cases A-Z only
    (``bytes`` methods touch ASCII alone)."""
    raw = text.encode("utf-8", "replace")
    return (raw.lower() if lower else raw).split()


class WordHash(dict):
    """64-bit hash of a word, remembered; emptied when it grows too large."""

    def __init__(self, most: int = 1 << 16):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, ws: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), dtype=np.uint64, count=len(ws))


def mix64(x: np.ndarray) -> np.ndarray:
    """Invertible scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive word hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    base = np.uint64(0x9E3779B97F4A7C15)
    for j in range(k):
        out = out * base + h[j : j + n]
    return mix64(out)


class Bits:
    """A fixed number of bits, addressed by hash."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(64 * len(words) - 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        h = h & self.mask
        return (self.words[(h >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) != 0


def bitmap(hashes: DataFrame, column: str, bits: int):
    """Broadcast variable with the words of ``Bits`` for a column of hashes; its
    size does not depend on their number."""
    if bits < 64 or bits & (bits - 1):
        raise ValueError("a bitmap has a power of two bits, 64 at least")
    slot = F.expr(f"pmod(`{column}`, {bits}L) div 64").alias("slot")
    bit = F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))").alias("bit")
    slots = hashes.select(slot, bit).groupBy("slot").agg(F.bit_or("bit").alias("bits"))  # bits / 64 rows at most
    each = min(SLOTS_A_BLOCK, bits // 64)

    def block(key, pdf: pd.DataFrame) -> pd.DataFrame:
        words = np.zeros(each, np.int64)
        words[pdf["slot"].to_numpy(np.int64) % each] = pdf["bits"].to_numpy(np.int64)
        return pd.DataFrame({"block": [key[0]], "words": [words.tobytes()]})

    blocks = slots.withColumn("block", F.expr(f"slot div {each}")).groupBy("block").applyInPandas(block, "block long, words binary")
    words = np.zeros(bits // 64, np.uint64)
    for r in blocks.collect():  # a few rows of bytes: the bitmap itself
        words[r["block"] * each : (r["block"] + 1) * each] = np.frombuffer(r["words"], np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(words)
