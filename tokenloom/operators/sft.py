"""Instruction-tuning examples (P7-P9, P12, F5/F6 on triples, G6, G7).

Instruction triples ``(instruction, context, response)`` come from a
conversation table: a user turn directly followed by an assistant turn of
the same conversation; ``context`` is the conversation's system text or
``""``.  Both are equi-joins on the conversation key (no window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.operators import pack, tokenizer
from tokenloom.operators.tokenizer import IGNORE_INDEX


def triples_from_conversations(conv: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                               text: str = "text") -> DataFrame:
    """``(conv_id, turn, instruction, context, response)``; ``turn`` is the
    assistant turn.  Null texts read as ``""``."""
    c = conv.select(conv_id, turn, role, F.coalesce(F.col(text), F.lit("")).alias("_t"))
    users = c.filter(F.col(role) == "user").select(conv_id, (F.col(turn) + 1).alias(turn), F.col("_t").alias("instruction"))
    asst = c.filter(F.col(role) == "assistant").select(conv_id, turn, F.col("_t").alias("response"))
    system = c.filter(F.col(role) == "system").groupBy(conv_id).agg(F.min_by("_t", turn).alias("context"))
    t = users.join(asst, [conv_id, turn]).join(system, conv_id, "left")
    return t.select(conv_id, turn, "instruction", F.coalesce("context", F.lit("")).alias("context"), "response")


def sft_rows(triples: DataFrame, vocab: DataFrame, keys=("conv_id", "turn"), block: int = 64, eos_id: int = 0,
             truncate_pad: bool = True) -> DataFrame:
    """P7 (+ P8, P9): ``prompt = instruction + " " + context`` (always with the
    space); ``input_ids`` = prompt ids + response ids + end id; ``labels`` =
    -100 per prompt token, then the response ids and end id; cut to
    ``block`` and right-padded with the end id / -100.

    Word-level tokens: the end token is appended as an id (the text form
    ``response + "<|endoftext|>"`` would glue it to the last word)."""
    keys = list(keys)
    t = triples.withColumn("_prompt", F.concat(F.col("instruction"), F.lit(" "), F.col("context")))
    p = tokenizer.encode(t.select(*keys, "_prompt"), vocab, keys, "_prompt", out="prompt_ids", carry=[])
    r = tokenizer.encode(t.select(*keys, "response"), vocab, keys, "response", out="_rids", carry=[])
    r = r.withColumn("response_ids", F.concat("_rids", F.array(F.lit(eos_id)))).drop("_rids")
    d = pack.sft_example(p.join(r, keys), "prompt_ids", "response_ids")
    if truncate_pad:
        d = pack.pad_to(pack.truncate(d, block), block, eos_id)
    return d


def position_pairs(rows: DataFrame, keys=("conv_id", "turn"), ids: str = "input_ids", labels: str = "labels",
                   shifted: bool = True) -> DataFrame:
    """Per position ``i``: ``prev = ids[i]`` and the target label.

    ``shifted=True`` (P12): target = ``labels[i+1]``, positions
    ``0 .. len-2`` (scores lose their last position, labels their first).
    ``shifted=False`` (older variant): target = ``labels[i]``."""
    keys = list(keys)
    if shifted:
        n = F.greatest(F.size(ids) - 1, F.lit(0))
        z = F.arrays_zip(F.slice(ids, 1, n).alias("prev"), F.slice(labels, 2, n).alias("target"))
    else:
        z = F.arrays_zip(F.col(ids).alias("prev"), F.col(labels).alias("target"))
    ex = rows.select(*keys, F.posexplode(z).alias("pos", "_z"))
    return ex.select(*keys, "pos", F.col("_z.prev").alias("prev"), F.col("_z.target").alias("target"))


def masked_losses(pairs: DataFrame, model: DataFrame, vocab_size, alpha: float = 1.0) -> DataFrame:
    """Per-position loss ``-ln p(target | prev)`` under a count model, with
    ``valid = target != -100`` (masked positions get a null loss)."""
    from tokenloom.operators.positions import attach_scalars

    m = model.select("prev", F.col("next").alias("target"), "c")
    pv = model.select("prev", "c_prev").distinct()
    valid = F.col("target") != F.lit(IGNORE_INDEX)
    # Masked positions match nothing and share one key: they skip the join.
    masked = pairs.where(~F.coalesce(valid, F.lit(False))).withColumn("valid", valid).withColumn("loss", F.lit(None).cast("double"))
    j = pairs.where(valid).join(m, ["prev", "target"], "left").join(F.broadcast(pv), "prev", "left")  # pv: <= vocabulary rows
    if isinstance(vocab_size, DataFrame):
        j = attach_scalars(j, vocab_size.select("vocab_size"))
        v = F.col("vocab_size")
    else:
        v = F.lit(vocab_size)
    p = (F.coalesce("c", F.lit(0)) + F.lit(alpha)) / (F.coalesce("c_prev", F.lit(0)) + F.lit(alpha) * v)
    return j.withColumn("valid", valid).withColumn("loss", -F.log(p)).drop("c", "c_prev", "vocab_size").unionByName(masked)


def masked_mean_loss(losses: DataFrame, group=(), guard: bool = True, digits: int = 6) -> DataFrame:
    """Sum of valid losses / number of valid positions per group; 0 when
    none is valid (``guard``).  G7 (``guard=False``): null when none is valid."""
    group = [group] if isinstance(group, str) else list(group)
    n_valid = F.sum(F.col("valid").cast("long"))
    mean = F.try_divide(F.sum("loss"), n_valid)
    val = F.coalesce(mean, F.lit(0.0)) if guard else mean
    agg = losses.groupBy(*group) if group else losses
    return agg.agg(n_valid.alias("n_valid"), F.round(val, digits).alias("masked_loss"))
