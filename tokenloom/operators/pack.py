"""Packing and layout.

The reference writes one flat int32 token stream and addresses it by
position.  Here the stream is a block table ``(streams..., block_id,
tokens array<int>)`` and the global position of ``tokens[i]`` is
``block_id * B + i``.  Document start offsets come from the bucketed prefix
sum (no single-task window); the block regroup is one shuffle keyed by
``block_id`` whose groups hold at most ``B + lookahead`` tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.positions import ROW_ID, attach_scalars, prefix_sum, running, stage_rows
from tokenloom.operators.tokenizer import IGNORE_INDEX


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def global_offsets(df: DataFrame, ids: str = "ids", order=("doc_id",), streams=(), out: str = "offset",
                   key_source: DataFrame | None = None) -> DataFrame:
    """Start position of each row in one concatenated token stream
    (running write offset), plus ``n_tokens``."""
    d = df.withColumn("n_tokens", F.coalesce(F.size(ids), F.lit(0)).cast("long"))
    return prefix_sum(d, "n_tokens", _as_list(order), _as_list(streams), out=out, key_source=key_source)


def align_each(df: DataFrame, ids: str = "ids", block: int = 64) -> DataFrame:
    """Each row loses its own tail of ``len % B`` tokens."""
    n = F.size(ids)
    return df.withColumn(ids, F.slice(ids, 1, n - n % F.lit(block)))


def pack_blocks(df: DataFrame, ids: str = "ids", order=("doc_id",), streams=(), block: int = 64,
                policy: str = "global", cap: int | DataFrame | None = None, lookahead: int = 0,
                key_source: DataFrame | None = None, materialize: bool = True) -> DataFrame:
    """Concatenate the id arrays in ``order`` per stream, cut into
    blocks of ``block`` and drop the tail.

    * ``policy="global"``: one stream, tail ``N % B`` dropped (P2);
      ``policy="per_chunk"``: every row first loses its own tail (P3).
    * ``cap``: the stream is silently cut at ``cap`` tokens (P4): a number, or
      a frame of one row with a column ``cap`` (an estimate that the same plan
      makes).
    * ``lookahead=L``: every block also carries the next ``L`` tokens of the
      kept stream (X/Y shifted pairs without a join; the last block has none).

    Output ``(streams..., block_id, tokens)``; every row of a stream's
    blocks ``0 .. nb-1`` holds exactly ``B`` (+ lookahead) tokens.
    Documents of any size, any number of documents per stream and any number
    of streams are fine; a null stream is a stream of its own.
    ``key_source``: cheap frame with the order key for bucket boundaries.
    The input is stored once (``positions.stage_rows``) unless it already is:
    offsets come from its keys and sizes alone.  ``materialize=False`` writes
    no table and lets the rows ride through the scan: for small inputs.
    """
    order, streams = _as_list(order), _as_list(streams)
    staged = [ROW_ID] if ROW_ID in df.columns else []
    d = df.select(*staged, *streams, *order, F.col(ids).alias("_ids"))
    if policy == "per_chunk":
        d = align_each(d, "_ids", block)
    elif policy != "global":
        raise ValueError(f"unknown policy {policy!r}")
    d = d.withColumn("_n", F.size("_ids").cast("long")).filter(F.col("_n") > 0)
    if materialize:
        d = prefix_sum(stage_rows(d, "pack-input"), "_n", order, streams, out="_s", key_source=key_source, total_out="_total")
    else:
        d = running(d, "_n", "sum", order, streams, out="_s", inclusive=False, key_source=key_source, total_out="_total")
    kept = F.col("_total") - F.col("_total") % F.lit(block)
    if isinstance(cap, DataFrame):
        d, kept = attach_scalars(d, cap.select(F.col("cap").alias("_cap"))), F.least(kept, F.col("_cap"))
    elif cap is not None:
        kept = F.least(kept, F.lit(int(cap)))
    d = d.withColumn("_kept", kept)
    B, L = block, lookahead
    s, n, k = F.col("_s"), F.col("_n"), F.col("_kept")
    n_blocks = F.ceil(k / F.lit(B)).cast("long")
    lo = F.greatest(F.lit(0).cast("long"), F.ceil((s - F.lit(B + L) + 1) / F.lit(B)).cast("long"))
    hi = F.least(n_blocks - 1, F.floor((s + n - 1) / F.lit(B)).cast("long"))
    d = d.filter(lo <= hi).select(*streams, "_ids", "_s", "_n", "_kept", F.explode(F.sequence(lo, hi)).alias("block_id"))
    a = F.greatest(s, F.col("block_id") * B)
    e = F.least(s + n, F.col("block_id") * B + F.lit(B + L), k)
    want = F.least(F.col("block_id") * B + F.lit(B + L), k) - F.col("block_id") * B  # tokens the block holds
    d = d.filter(e > a).select(
        *streams, "block_id", a.alias("_a"), F.slice("_ids", (a - s + 1).cast("int"), (e - a).cast("int")).alias("_piece"),
        ((a == F.col("block_id") * B) & ((e - a) == want)).alias("_whole"),
    )
    # A block inside one document is complete as it is: no grouping.  Only
    # blocks that span documents are regrouped, after one exchange on the
    # block key (no map-side partial collect).
    whole = d.filter("_whole").select(*streams, "block_id", F.col("_piece").alias("tokens"))
    parts = d.filter(~F.col("_whole")).repartition(*[F.col(c) for c in streams], F.col("block_id"))
    g = parts.groupBy(*streams, "block_id").agg(F.array_sort(F.collect_list(F.struct("_a", "_piece"))).alias("_l"))
    glued = g.select(*streams, "block_id", F.flatten(F.transform("_l", lambda x: x["_piece"])).alias("tokens"))
    return whole.unionByName(glued)


def unpack(blocks: DataFrame, block: int = 64, streams=(), tokens: str = "tokens") -> DataFrame:
    """Inverse view of a block table: ``(streams..., pos, token)``."""
    streams = _as_list(streams)
    ex = blocks.select(*streams, "block_id", F.posexplode(F.slice(tokens, 1, block)).alias("_i", "token"))
    return ex.select(*streams, (F.col("block_id") * block + F.col("_i")).alias("pos"), "token")


def concat_batches(df: DataFrame, order: str = "row_no", ids: str = "input_ids", rows: int = 1_000_000,
                   n_shards: int = 8, n_rows: int | None = None) -> DataFrame:
    """P5: ``n_shards`` contiguous shards (the first ``n % shards`` get one
    extra row), batches of up to ``rows`` rows inside each shard, the lists of
    every batch concatenated in row order.  ``order`` is a 0-based row number.

    The concatenation is a layout: each row gets its ``shard``, ``batch`` and
    the ``offset`` of its list in that batch, so no batch is ever one value.
    ``pack_blocks(streams=["shard", "batch"])`` cuts it into chunks (P6)."""
    if n_rows is None:
        n_rows = df.count()
    div, mod = divmod(n_rows, n_shards)
    r = F.col(order)
    big = F.lit((div + 1) * mod)
    shard = F.when(r < big, F.floor(r / F.lit(div + 1))).otherwise(F.lit(mod) + F.floor((r - big) / F.lit(max(div, 1))))
    start = F.when(shard < F.lit(mod), shard * F.lit(div + 1)).otherwise(big + (shard - F.lit(mod)) * F.lit(div))
    d = df.withColumn("shard", shard.cast("int")).withColumn("batch", F.floor((r - start) / F.lit(rows)).cast("long"))
    return global_offsets(d, ids, [order], ["shard", "batch"], out="offset")


def chunk_fixed(df: DataFrame, cols=("input_ids", "attention_mask"), size: int = 1024, keys=()) -> DataFrame:
    """Fixed-size pieces of each row's lists; a short last piece is dropped.
    Row-local (explode of ``sequence``), no shuffle."""
    cols, keys = _as_list(cols), _as_list(keys)
    n = F.size(cols[0])
    d = df.filter(n >= F.lit(size)).select(*keys, *cols, F.explode(F.sequence(F.lit(0), (n / F.lit(size)).cast("int") - 1)).alias("chunk"))
    return d.select(*keys, "chunk", *[F.slice(c, F.col("chunk") * size + 1, size).alias(c) for c in cols])


def sft_example(df: DataFrame, prompt_ids: str = "prompt_ids", response_ids: str = "response_ids") -> DataFrame:
    """``input_ids`` = prompt ids + response ids (the response already
    ends with the end token); ``labels`` = -100 per prompt token, then the
    response ids."""
    return df.withColumn("input_ids", F.concat(prompt_ids, response_ids)).withColumn(
        "labels", F.concat(F.array_repeat(F.lit(IGNORE_INDEX), F.size(prompt_ids)), F.col(response_ids))
    )


def truncate(df: DataFrame, block: int = 64, cols=("input_ids", "labels")) -> DataFrame:
    """Cut to ``block``."""
    for c in _as_list(cols):
        df = df.withColumn(c, F.slice(c, 1, block))
    return df


def pad_to(df: DataFrame, block: int = 64, pad_id: int = 0, ids: str = "input_ids", labels: str = "labels") -> DataFrame:
    """Right-pad ids with ``pad_id`` (the end token) and labels with -100."""
    pad = F.greatest(F.lit(0), F.lit(block) - F.size(ids))
    return df.withColumn(labels, F.concat(labels, F.array_repeat(F.lit(IGNORE_INDEX), F.greatest(F.lit(0), F.lit(block) - F.size(labels))))).withColumn(
        ids, F.concat(ids, F.array_repeat(F.lit(pad_id), pad))
    )


def reshape_check(df: DataFrame, block: int = 64, pad_id: int = 0) -> DataFrame:
    """Keep a uniform width (truncate, then pad)."""
    return pad_to(truncate(df, block), block, pad_id)


def collate_causal(df: DataFrame, pad_id: int, ids: str = "input_ids", out: str = "labels") -> DataFrame:
    """P10: labels = ids with pad ids set to -100 (the pad is the end token,
    so real end tokens are masked too)."""
    return df.withColumn(out, F.transform(ids, lambda x: F.when(x == F.lit(pad_id), F.lit(IGNORE_INDEX)).otherwise(x)))


def shift_xy(windows: DataFrame, block: int = 64, tokens: str = "tokens") -> DataFrame:
    """From a window of B+1 tokens, X = first B, Y = the same window
    one to the right (Y[i] is the next token of X[i])."""
    return windows.withColumn("x", F.slice(tokens, 1, block)).withColumn("y", F.slice(tokens, 2, block))


def shift_labels(df: DataFrame, labels: str = "labels", out: str = "shift_labels") -> DataFrame:
    """Drop the first label (scores lose their last position);
    validity = label != -100; ``n_valid`` counts them."""
    sl = F.slice(labels, 2, F.greatest(F.size(labels) - 1, F.lit(0)))
    return df.withColumn(out, sl).withColumn("n_valid", F.size(F.filter(out, lambda x: x != F.lit(IGNORE_INDEX))).cast("long"))
