"""Score tables: top-k, softmax, nucleus filtering and draws (O1, O2, W6,
G4, G5, G10, J4, J6, J7, M3, M4).

A score table is long form ``(seq_id, token, logit)``: one row per
candidate token of a sequence position (at most the vocabulary per
``seq_id``).  Per-sequence windows therefore hold a bounded number of rows.
``row_number() <= k`` filters are planned by Spark with a map-side
``WindowGroupLimit`` before the exchange, so a top-k never ships more than
k rows per group and task.  Ties are broken by token id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.keyed import keyed_uniform


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def vectors_to_scores(df: DataFrame, key: str = "vec_id", vec: str = "embedding", out_key: str = "seq_id") -> DataFrame:
    """Long form of an ``array<float>`` column: ``(seq_id, token, logit)``
    with ``token`` = 0-based index and the score as double."""
    ex = df.select(F.col(key).alias(out_key), F.posexplode(vec).alias("token", "_v"))
    return ex.select(out_key, "token", F.col("_v").cast("double").alias("logit"))


def topk_per_group(df: DataFrame, group, order, k: int, tiebreak=("token",), rank_col: str = "rank") -> DataFrame:
    """O1: the ``k`` best rows per group (``row_number`` over the order,
    then ``tiebreak`` ascending); adds a 1-based ``rank``."""
    order = [F.col(o) if isinstance(o, str) else o for o in _as_list(order)] + [F.col(t).asc() for t in _as_list(tiebreak)]
    w = Window.partitionBy(*_as_list(group)).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= F.lit(k))


def sort_desc(df: DataFrame, group: str = "seq_id", col: str = "prob", index: str = "token") -> DataFrame:
    """Order of scores with the source index carried in the row
    (``take_along_axis`` becomes a column, not a join)."""
    w = Window.partitionBy(group).orderBy(F.col(col).desc(), F.col(index).asc())
    return df.withColumn("sort_pos", F.row_number().over(w) - 1)


def log_softmax(df: DataFrame, group: str = "seq_id", logit: str = "logit", out: str = "logprob") -> DataFrame:
    """``logit - (max + ln sum exp(logit - max))`` per group."""
    w = Window.partitionBy(group)
    m = F.max(logit).over(w)
    lse = m + F.log(F.sum(F.exp(F.col(logit) - m)).over(w))
    return df.withColumn(out, F.col(logit) - lse)


def softmax(df: DataFrame, group: str = "seq_id", logit: str = "logit", out: str = "prob") -> DataFrame:
    """Probabilities per group."""
    return log_softmax(df, group, logit, "_lp").withColumn(out, F.exp("_lp")).drop("_lp")


def cumulative_prob(df: DataFrame, group: str = "seq_id", prob: str = "prob", order=None, out: str = "cum_prob") -> DataFrame:
    """Running sum of probabilities in descending order (ties by token)."""
    order = order or [F.col(prob).desc(), F.col("token").asc()]
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(prob).over(w))


def target_score(scores: DataFrame, labels: DataFrame, group: str = "seq_id", label: str = "label") -> DataFrame:
    """The score of the target token (one-hot product = equi-join on
    ``(seq, token)``)."""
    lab = labels.select(F.col(group), F.col(label).alias("token"))
    return scores.join(lab, [group, "token"], "inner")


def cross_entropy(scores: DataFrame, labels: DataFrame, group: str = "seq_id", label: str = "label", digits: int = 6) -> DataFrame:
    """G4 + J6 + G5: mean of ``-log p(target)`` over sequences, and its
    exponential (G9)."""
    lp = log_softmax(scores, group)
    t = target_score(lp, labels, group, label)
    ce = F.avg(-F.col("logprob"))
    return t.agg(F.count(F.lit(1)).alias("n"), F.round(ce, digits).alias("cross_entropy"), F.round(F.exp(ce), digits).alias("perplexity"))


def nucleus(scores: DataFrame, k: int = 40, p: float = 0.9, temperature: float = 0.8, group: str = "seq_id",
            logit: str = "logit", fallback: bool = True) -> DataFrame:
    """M3: scores / T, top-k, softmax over the k, keep tokens whose
    cumulative probability is <= p (the token that crosses p is excluded, as
    in the reference), else the single best (``fallback``), then
    renormalise with ``+ 1e-10``.  Output adds ``rank, prob, cum_prob, q``."""
    d = scores.withColumn("_s", F.col(logit) / F.lit(float(temperature)))
    d = topk_per_group(d, group, [F.col("_s").desc()], k)
    d = softmax(d, group, "_s", "prob")
    d = cumulative_prob(d, group, "prob", order=[F.col("rank").asc()])
    keep = F.col("cum_prob") <= F.lit(float(p))
    if fallback:
        keep = keep | (F.col("rank") == 1)
    d = d.filter(keep)
    w = Window.partitionBy(group)
    return d.withColumn("q", F.col("prob") / (F.sum("prob").over(w) + F.lit(1e-10))).drop("_s")


def sample_token(kept: DataFrame, seed=42, group: str = "seq_id", draw_keys=(), out: str = "token") -> DataFrame:
    """M4: categorical draw from the kept set by inverse CDF: the first
    token (in rank order) whose cumulative ``q`` exceeds a keyed uniform
    ``u(seed, 'draw', group, draw_keys...)``; the last kept token if the
    mass (1 - 1e-10 rounding) is never exceeded.  One row per group."""
    keys = [group, *_as_list(draw_keys)]
    w = Window.partitionBy(*keys).orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = kept.withColumn("_cq", F.sum("q").over(w)).withColumn("_u", keyed_uniform(seed, "draw", *keys))
    hit = F.when(F.col("_cq") > F.col("_u"), F.struct("rank", F.col("token").alias("t")))
    g = d.groupBy(*keys).agg(F.min(hit).alias("_h"), F.max(F.struct("rank", F.col("token").alias("t"))).alias("_l"))
    return g.select(*keys, F.coalesce(F.col("_h.t"), F.col("_l.t")).alias(out))


def standardize_vectors(df: DataFrame, vec: str = "embedding", eps: float = 1e-5, scale: float = 1.0, bias: float = 0.0,
                        out: str = "normed") -> DataFrame:
    """``(x - mean) / sqrt(var_pop + eps) * scale + bias`` per vector,
    in array form (``aggregate`` / ``transform``), no explode or shuffle."""
    x = F.transform(vec, lambda v: v.cast("double"))
    n = F.size(vec).cast("double")
    mean = F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / n
    d = df.withColumn("_x", x).withColumn("_mean", mean)
    var = F.aggregate("_x", F.lit(0.0), lambda a, v: a + (v - F.col("_mean")) * (v - F.col("_mean"))) / n
    d = d.withColumn("_den", F.sqrt(var + F.lit(eps)))
    d = d.withColumn(out, F.transform("_x", lambda v: (v - F.col("_mean")) / F.col("_den") * F.lit(scale) + F.lit(bias)))
    return d.drop("_x", "_mean", "_den")


def lookup_vectors(ids: DataFrame, vectors: DataFrame, token: str = "token", key: str = "vec_id", how: str = "left") -> DataFrame:
    """Attach the vector of every token id; an id without a vector keeps
    its row, with nulls (``how="inner"`` drops it).  The vector table grows
    with the data, so it is not broadcast by hint."""
    return ids.join(vectors.withColumnRenamed(key, token), token, how)
