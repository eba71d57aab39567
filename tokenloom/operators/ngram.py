"""Count-based next-token model (M1, M2, M6).

This is **not** the reference's neural model.  It is the stand-in that
runs at corpus scale and closes the loop from raw documents to validation
perplexity with the same objective (next-token likelihood):

    p(next | prev) = (c(prev, next) + alpha) / (c(prev) + alpha * V)

V = vocabulary size; an unseen ``prev`` gives ``1 / V``.  Pairs are taken
from the kept token stream: ``(token[p], token[p+1])`` with both positions
in the same split (inside a block, and across to the next block, as the
X/Y shift does).  Counting is ``groupBy`` with map-side partial
aggregation, so the shuffle carries distinct pairs per task, not tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def block_pairs(blocks: DataFrame, block: int = 64, streams=(), tokens: str = "tokens") -> DataFrame:
    """Adjacent pairs of a block table built with ``lookahead >= 1``:
    ``(streams..., pos, prev, next)`` where ``pos`` is the position of prev."""
    streams = _as_list(streams)
    t = F.col(tokens)
    n_pairs = F.least(F.size(t) - 1, F.lit(block))
    z = F.arrays_zip(F.slice(t, 1, n_pairs).alias("a"), F.slice(t, 2, n_pairs).alias("b"))
    ex = blocks.select(*streams, "block_id", F.posexplode(z).alias("_i", "_ab"))
    return ex.select(
        *streams,
        (F.col("block_id") * F.lit(block) + F.col("_i")).alias("pos"),
        F.col("_ab.a").alias("prev"),
        F.col("_ab.b").alias("next"),
    )


def pairs_in_split(pairs: DataFrame, bounds: DataFrame, split: str, streams=()) -> DataFrame:
    """Pairs whose two positions both lie in ``[start, end)`` of the split."""
    streams = _as_list(streams)
    b = bounds.filter(F.col("split") == F.lit(split)).select(*streams, "start", "end")
    if streams:
        j = pairs.join(F.broadcast(b), streams)
    else:
        from tokenloom.operators.positions import attach_scalars

        j = attach_scalars(pairs, b)
    return j.filter((F.col("pos") >= F.col("start")) & (F.col("pos") + 1 < F.col("end"))).drop("start", "end")


def split_pair_counts(pairs: DataFrame, bounds: DataFrame, streams=()) -> DataFrame:
    """One pass over the pairs: tag each with its split (both positions in
    train, or both in validation; the crossing pair belongs to neither) and
    count ``(streams, split, prev, next)`` with partial aggregation.  Feeds
    both the model (train rows) and the evaluation (val rows)."""
    streams = _as_list(streams)
    cuts = bounds.groupBy(*streams).agg(
        F.max(F.when(F.col("split") == "train", F.col("end"))).alias("_te"), F.max("end").alias("_n")
    )
    if streams:
        j = pairs.join(F.broadcast(cuts), streams)
    else:
        from tokenloom.operators.positions import attach_scalars

        j = attach_scalars(pairs, cuts)
    pos = F.col("pos")
    split = F.when(pos + 1 < F.col("_te"), F.lit("train")).when((pos >= F.col("_te")) & (pos + 1 < F.col("_n")), F.lit("val"))
    j = j.withColumn("split", split).filter(F.col("split").isNotNull())
    return j.groupBy(*streams, "split", "prev", "next").agg(F.count(F.lit(1)).alias("c"))


def fit_from_counts(counts: DataFrame, streams=()) -> DataFrame:
    """M1 from pre-aggregated training pair counts ``(streams, prev, next, c)``."""
    streams = _as_list(streams)
    pc = counts.select(*streams, "prev", "next", "c")
    prev = pc.groupBy(*streams, "prev").agg(F.sum("c").alias("c_prev"))
    # at most (streams x vocabulary) rows: broadcast, so a frequent prev
    # token (followed by many distinct tokens) never lands in one task
    return pc.join(F.broadcast(prev), [*streams, "prev"])


def fit_next_token(train_pairs: DataFrame, streams=()) -> DataFrame:
    """M1: the model table ``(streams..., prev, next, c, c_prev)``."""
    streams = _as_list(streams)
    pc = train_pairs.groupBy(*streams, "prev", "next").agg(F.count(F.lit(1)).alias("c"))
    return fit_from_counts(pc, streams)


def next_token_probs(model: DataFrame, vocab_size, alpha: float = 1.0) -> DataFrame:
    """M1 probabilities of the seen pairs; ``vocab_size`` is an int or a
    one-row frame with a ``vocab_size`` column."""
    if isinstance(vocab_size, DataFrame):
        from tokenloom.operators.positions import attach_scalars

        model = attach_scalars(model, vocab_size.select("vocab_size"))
        v = F.col("vocab_size")
    else:
        v = F.lit(vocab_size)
    p = (F.col("c") + F.lit(alpha)) / (F.col("c_prev") + F.lit(alpha) * v)
    return model.withColumn("p", p).drop("vocab_size")


HOT_PAIRS, SALTS = 256, 64


def spread_hot(m: DataFrame, pc: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join on ``keys`` with a ``_salt``: a pair that makes
    up 1/HOT_PAIRS of the model's count or more has its rows dealt over SALTS
    slices, and its one model row repeated for each.  By their definition there
    are at most HOT_PAIRS such pairs, so they are broadcast."""
    from tokenloom.operators.positions import attach_scalars

    total = pc.agg(F.sum("c").alias("_all"))
    hot = attach_scalars(pc, total).filter(F.col("c") * F.lit(HOT_PAIRS) >= F.col("_all")).select(*keys, F.lit(True).alias("_hot"))
    hot = F.broadcast(hot)
    others = [c for c in m.columns if c not in keys] or keys
    deal = F.pmod(F.xxhash64(*others), F.lit(SALTS)).cast("int")
    salted = m.join(hot, keys, "left").withColumn("_salt", F.when(F.col("_hot"), deal).otherwise(F.lit(0))).drop("_hot")
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    slices = pc.join(hot, keys, "left").withColumn("_salt", F.explode(every)).drop("_hot")
    return salted, slices


def score_pairs(pairs: DataFrame, model: DataFrame, vocab_size: int, alpha: float = 1.0, streams=(), group=()) -> DataFrame:
    """Sum of ``-ln p`` and pair count per ``group`` (M2/M6 core).

    Pairs are first collapsed to ``(group, streams, prev, next, mult)`` so the
    joins carry distinct pairs; then left joins to pair and prev counts."""
    streams, group = _as_list(streams), _as_list(group)
    keys = list(dict.fromkeys([*group, *streams]))
    if "mult" in pairs.columns:  # already aggregated (split_pair_counts)
        m = pairs.select(*keys, "prev", "next", "mult")
    else:
        m = pairs.groupBy(*keys, "prev", "next").agg(F.count(F.lit(1)).alias("mult"))
    pc = model.select(*streams, "prev", "next", "c")
    prev = model.select(*streams, "prev", "c_prev").distinct()  # <= streams x vocabulary rows
    salted, slices = spread_hot(m, pc, [*streams, "prev", "next"])
    j = salted.join(slices, [*streams, "prev", "next", "_salt"], "left").join(F.broadcast(prev), [*streams, "prev"], "left")
    if isinstance(vocab_size, DataFrame):  # one-row frame with column vocab_size
        from tokenloom.operators.positions import attach_scalars

        j = attach_scalars(j, vocab_size.select("vocab_size"))
        v = F.col("vocab_size")
    else:
        v = F.lit(vocab_size)
    c = F.coalesce(F.col("c"), F.lit(0))
    cp = F.coalesce(F.col("c_prev"), F.lit(0))
    nll = -F.log((c + F.lit(alpha)) / (cp + F.lit(alpha) * v))
    return j.groupBy(*group).agg(F.sum(F.col("mult") * nll).alias("nll_sum"), F.sum("mult").cast("long").alias("n_pairs"))


def evaluate_model(val_pairs: DataFrame, model: DataFrame, vocab_size: int, alpha: float = 1.0, streams=(),
                   digits: int = 6) -> DataFrame:
    """M2 (+ G5, G9): cross-entropy and perplexity over the *whole*
    validation split, per stream."""
    s = score_pairs(val_pairs, model, vocab_size, alpha, streams, group=streams)
    ce = F.col("nll_sum") / F.col("n_pairs")
    return s.select(*_as_list(streams), "n_pairs", F.round(ce, digits).alias("cross_entropy"), F.round(F.exp(ce), digits).alias("perplexity"))


def doc_pairs(docs: DataFrame, key: str = "doc_id", ids: str = "ids", carry=()) -> DataFrame:
    """Adjacent pairs inside each document's id array."""
    t = F.col(ids)
    n = F.greatest(F.size(t) - 1, F.lit(0))
    z = F.arrays_zip(F.slice(t, 1, n).alias("a"), F.slice(t, 2, n).alias("b"))
    ex = docs.select(key, *_as_list(carry), F.explode(z).alias("_ab"))
    return ex.select(key, *_as_list(carry), F.col("_ab.a").alias("prev"), F.col("_ab.b").alias("next"))


def rank_docs_by_perplexity(docs: DataFrame, model: DataFrame, vocab_size: int, alpha: float = 1.0, key: str = "doc_id",
                            ids: str = "ids", streams=(), digits: int = 6) -> DataFrame:
    """M6: per-document cross-entropy and perplexity under the model (the
    batch-scoring use of the same loss); documents with no pair are absent."""
    streams = _as_list(streams)
    pairs = doc_pairs(docs, key, ids, carry=streams)
    s = score_pairs(pairs, model, vocab_size, alpha, streams, group=[key, *streams])
    ce = F.col("nll_sum") / F.col("n_pairs")
    return s.select(key, *streams, "n_pairs", F.round(ce, digits).alias("cross_entropy"), F.round(F.exp(ce), digits).alias("perplexity"))
