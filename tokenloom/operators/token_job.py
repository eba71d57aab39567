"""The whole tokenizing job of the trainer: corpus text to one capped token
stream in blocks (T8 -> T9 -> P3 -> P4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.operators import pack, tokenizer
from tokenloom.operators.positions import stage_rows


def tokenize_to_blocks(docs: DataFrame, vocab: DataFrame, key: str = "doc_id", col: str = "text", n_lines: int = 20000,
                       sample_chars: int = 10 * 1024 * 1024, block: int = 64, key_source: DataFrame | None = None) -> DataFrame:
    """``(block_id, tokens)`` of the corpus file that holds each text and a line
    feed, in ``key`` order.

    The stream's cap is T8's estimate: the tokens of the first ``sample_chars``
    characters, scaled to all bytes and aligned down.  Groups of ``n_lines``
    lines (T9) are encoded and each loses its own tail (P3); offsets come from
    the trimmed sizes alone, and the cap (one row of the same plan) cuts the
    block table as it is laid out."""
    text = F.concat(F.coalesce(F.col(col), F.lit("")), F.lit("\n"))
    rows = stage_rows(docs.select(key, text.alias("_file"), F.coalesce(F.col(col), F.lit("")).alias(col)), "token-job")
    cap = tokenizer.estimate_tokens(rows, vocab, key, "_file", sample_chars, block).select(F.col("estimated_aligned").alias("cap"))
    groups = tokenizer.doc_line_groups(rows.select(key, col), key, col, n_lines, key_source=key_source)
    ids = tokenizer.encode(groups, vocab, "group_id", "text", carry=[])
    return pack.pack_blocks(ids, "ids", ["group_id"], [], block, policy="per_chunk", cap=cap)
