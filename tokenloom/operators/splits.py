"""Splits, sampling and batching.

Token-stream splits are *bounds*: a small frame ``(streams..., split,
start, end)`` of half-open position ranges, broadcast to whatever needs
them.  Row splits number rows with the bucketed global row index.  Random
draws are keyed hashes of ``(seed, step, micro, slot)``, so a resumed or
retried job draws the same windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.keyed import keyed_hash
from tokenloom.operators.positions import attach_scalars, hash_splits, row_index


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def stream_lengths(blocks: DataFrame, streams=(), block: int = 64, tokens: str = "tokens") -> DataFrame:
    """Kept tokens per stream of a block table (lookahead not counted)."""
    streams = _as_list(streams)
    n = F.sum(F.least(F.size(tokens), F.lit(block)).cast("long")).alias("n")
    return blocks.groupBy(*streams).agg(n) if streams else blocks.agg(F.coalesce(n, F.lit(0).cast("long")).alias("n"))


def _bounds(lengths: DataFrame, streams, val_size) -> DataFrame:
    streams = _as_list(streams)
    n = F.col("n")
    cut = n - val_size
    train = lengths.select(*streams, F.lit("train").alias("split"), F.lit(0).cast("long").alias("start"), cut.cast("long").alias("end"))
    val = lengths.select(*streams, F.lit("val").alias("split"), cut.cast("long").alias("start"), n.cast("long").alias("end"))
    return train.unionByName(val)


def split_tail(lengths: DataFrame, denom: int = 5, streams=()) -> DataFrame:
    """K1: the last ``n // denom`` tokens are validation (none when it is 0)."""
    return _bounds(lengths, streams, F.floor(F.col("n") / F.lit(denom)))


def split_ratio(lengths: DataFrame, ratio: float = 0.2, streams=()) -> DataFrame:
    """K2: validation = the last ``int(n * ratio)`` tokens; not block aligned."""
    return _bounds(lengths, streams, F.floor(F.col("n") * F.lit(float(ratio))).cast("long"))


def split_rows(df: DataFrame, ratio: float = 0.1, order=("row_no",), out: str = "split") -> DataFrame:
    """K3: first ``int(n * (1 - ratio))`` rows in ``order`` are train, the
    rest validation.  Adds a 0-based ``row_no``-style index ``_idx``."""
    d = row_index(df, _as_list(order), out="_idx")
    n = df.agg(F.count(F.lit(1)).alias("_cnt"))
    d = attach_scalars(d, n)
    train_size = F.floor(F.col("_cnt") * F.lit(1.0 - float(ratio))).cast("long")
    return d.withColumn(out, F.when(F.col("_idx") < train_size, F.lit("train")).otherwise(F.lit("val"))).drop("_cnt")


def split_random(df: DataFrame, test_ratio: float = 0.0015, seed=42, keys=("doc_id",), out: str = "split") -> DataFrame:
    """K4: random split with an exact test count ``ceil(n * ratio)``; rows
    are ordered by a keyed hash (the shuffle), the first ``n_test`` are test.
    Adds ``shuffle_rank`` (0-based position in the shuffled order)."""
    keys = _as_list(keys)
    d = df.withColumn("_h", keyed_hash(seed, "split", *keys))
    d = row_index(d, ["_h", *keys], out="shuffle_rank", splits=hash_splits(df.sparkSession))
    n = df.agg(F.count(F.lit(1)).alias("_cnt"))
    d = attach_scalars(d, n)
    n_test = F.ceil(F.col("_cnt") * F.lit(float(test_ratio))).cast("long")
    return d.withColumn(out, F.when(F.col("shuffle_rank") < n_test, F.lit("test")).otherwise(F.lit("train"))).drop("_h", "_cnt")


def window_span(block: int):
    """K9: the window upper bound ``end - start - B - 1`` of a bounds row."""
    return F.col("end") - F.col("start") - F.lit(block + 1)


def require_span(n, block: int, strict: bool = True):
    """K9: the window upper bound ``n - B - 1``; error when not positive.

    ``n``: a token count (returns the bound), or a bounds frame (adds ``span``
    and ``ok``; ``strict`` makes a row where no window fits an error)."""
    need = f"tokens hold no window: blocks of {block} need at least {block + 2}"
    if isinstance(n, DataFrame):
        d = n.withColumn("span", window_span(block)).withColumn("ok", F.col("span") > 0)
        few = F.concat((F.col("end") - F.col("start")).cast("string"), F.lit(" " + need))
        return d.withColumn("ok", F.when(F.col("ok"), F.lit(True)).otherwise(F.raise_error(few).cast("boolean"))) if strict else d
    span = n - block - 1
    if span <= 0:
        raise ValueError(f"{n} {need}")
    return span


def kept_lengths(encoded: DataFrame, ids: str = "ids", streams=(), block: int = 64) -> DataFrame:
    """Kept tokens per stream of encoded rows: their sizes summed and aligned
    down to the block, without building blocks (equals ``stream_lengths``)."""
    streams = _as_list(streams)
    n = F.coalesce(F.sum(F.greatest(F.size(ids), F.lit(0)).cast("long")), F.lit(0))
    total = encoded.groupBy(*streams).agg(n.alias("n")) if streams else encoded.agg(n.alias("n"))
    return total.withColumn("n", F.col("n") - F.col("n") % F.lit(block)).filter(F.col("n") > 0)


def draw_starts(spark, bounds: DataFrame, split: str = "train", steps: int = 1, micro: int = 1, batch: int = 32,
                block: int = 64, seed=42, first_step: int = 0, streams=()) -> DataFrame:
    """K5/K6 draws: for every (step, micro, slot) a start ``j`` uniform on
    ``[0, end - start - B - 1)`` (upper bound exclusive, as in the
    reference), absolute position ``start + j``.  The draw key includes the
    step, so a resumed run does not repeat batches."""
    streams = _as_list(streams)
    b = bounds.filter(F.col("split") == F.lit(split)).withColumn("_span", window_span(block))
    b = b.filter(F.col("_span") > 0).select(*streams, "start", "_span")
    # Each stream's row gives its own draws, step by step.
    d = b.select("*", F.explode(F.sequence(F.lit(first_step).cast("long"), F.lit(first_step + steps - 1).cast("long"))).alias("step"))
    d = d.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(micro * batch - 1).cast("long"))).alias("_i"))
    d = d.withColumn("micro", F.floor(F.col("_i") / F.lit(batch))).withColumn("slot", F.col("_i") % F.lit(batch))
    j = keyed_hash(seed, "window", F.lit(split), *streams, "step", "micro", "slot") % F.col("_span")
    return d.select(*streams, "step", "micro", "slot", (F.col("start") + j).alias("pos"))


def gather_windows(starts: DataFrame, blocks: DataFrame, block: int = 64, tokens: str = "tokens", streams=()) -> DataFrame:
    """The B+1 tokens from each start.  A window starting in block
    b touches only b and b+1: explode both ids, equi-join the block table,
    regroup per draw, flatten in block order and slice.  Replaces a range
    join; X/Y follow with :func:`tokenloom.operators.pack.shift_xy`."""
    s = starts.withColumn("_b0", F.floor(F.col("pos") / F.lit(block)).cast("long"))
    s = s.select("*", F.explode(F.array(F.col("_b0"), F.col("_b0") + 1)).alias("block_id"))
    streams = _as_list(streams)
    j = s.join(blocks.select(*streams, "block_id", F.slice(tokens, 1, block).alias("_t")), [*streams, "block_id"])
    g = j.groupBy(*streams, "step", "micro", "slot", "pos", "_b0").agg(F.array_sort(F.collect_list(F.struct("block_id", "_t"))).alias("_l"))
    flat = F.flatten(F.transform("_l", lambda x: x["_t"]))
    off = (F.col("pos") - F.col("_b0") * F.lit(block) + 1).cast("int")
    return g.select(*streams, "step", "micro", "slot", "pos", F.slice(flat, off, block + 1).alias("tokens"))


def cyclic_batches(rows: DataFrame, n_rows: int, batch: int = 16, steps: int = 100, first_step: int = 0,
                   order: str = "row_no") -> DataFrame:
    """K7: step i reads rows ``[i*batch % n, min(that + batch, n))``: a short
    batch at the end, no wrap.  An interval join computed as an equi-join on
    exploded row numbers."""
    spark = rows.sparkSession
    st = spark.range(first_step, first_step + steps).withColumnRenamed("id", "step")
    start = (F.col("step") * F.lit(batch)) % F.lit(n_rows)
    end = F.least(start + F.lit(batch), F.lit(n_rows))
    ex = st.select("step", F.explode(F.sequence(start, end - 1)).alias(order))
    return ex.join(rows, order)


def first_batch(rows: DataFrame, n_rows: int, batch: int = 16, order: str = "row_no") -> DataFrame:
    """K8: the first ``min(batch, n)`` rows (SFT validation)."""
    return rows.filter(F.col(order) < F.lit(min(batch, n_rows)))
