"""M5: generate continuations for many prompts at once with the count model.

The candidates of a next token depend on the last token alone, so they are
filtered once: :func:`candidate_index` holds, per last token, the tokens that
M3 keeps (scores / T, top-k, top-p with the reference's "cumulative <= p, else
the best" rule, renormalised) as an array of at most ``k`` with their
cumulative weights.  Every round joins each prompt with the one index row of
its last token and draws by the M4 rule in that array (keyed draw, inverse
CDF).  Drawing the end token spends the step without adding a token; the
context is cut to the last ``block`` tokens.  The prompt state is
re-materialised every ``lineage_every`` rounds.

Candidates are the next tokens seen after a last token; a last token never
seen in training falls back to the ``k`` smallest non-special ids, which all
have probability ``1/V`` under the add-alpha model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.arrays import last_n
from tokenloom.functions.keyed import keyed_uniform
from tokenloom.operators import scores
from tokenloom.operators.positions import attach_scalars
from tokenloom.session import cut_lineage


def _cumulated(kept: DataFrame, group: str) -> DataFrame:
    """(group, tokens, cum): kept candidates in rank order, with running weights."""
    one = F.array_sort(F.collect_list(F.struct("rank", "token", "q")))
    d = kept.groupBy(group).agg(one.alias("_l"))
    first, rest = F.array(F.element_at("_l", 1)["q"]), F.slice("_l", 2, F.size("_l"))
    cum = F.aggregate(rest, first, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x["q"])))
    return d.select(group, F.transform("_l", lambda x: x["token"]).alias("tokens"), cum.alias("cum"))


def candidate_index(model: DataFrame, vocab: DataFrame, k: int = 40, p: float = 0.9, temperature: float = 0.8, alpha: float = 1.0):
    """Returns ``(index, fallback)``: a row ``(prev, tokens, cum)`` per seen
    last token, and one row ``(tokens, cum)`` for all others; arrays of at most
    ``k``."""
    v_size = vocab.agg(F.count(F.lit(1)).alias("V"))
    seen = attach_scalars(model.select("prev", F.col("next").alias("token"), "c", "c_prev"), v_size)
    logit = F.log((F.col("c") + F.lit(alpha)) / (F.col("c_prev") + F.lit(alpha) * F.col("V")))
    index = _cumulated(scores.nucleus(seen.select("prev", "token", logit.alias("logit")), k, p, temperature, group="prev"), "prev")
    other = vocab.filter(~F.col("special")).select(F.col("id").alias("token")).orderBy("token").limit(k)
    other = other.withColumn("prev", F.lit(0)).withColumn("logit", F.lit(0.0))
    return index, _cumulated(scores.nucleus(other, k, p, temperature, group="prev"), "prev").drop("prev")


def draw(tokens, cum, u):
    """First token whose cumulative weight exceeds ``u``, else the last one."""
    passed = F.size(F.filter(cum, lambda x: x <= u))
    return F.element_at(tokens, F.least(passed + 1, F.size(tokens)))


def generate(prompts: DataFrame, model: DataFrame, vocab: DataFrame, n_new: int = 8, k: int = 40, p: float = 0.9,
             temperature: float = 0.8, seed=42, block: int = 64, end_id: int = 0, key: str = "prompt_id",
             ids: str = "ids", alpha: float = 1.0, lineage_every: int = 1) -> DataFrame:
    """Returns ``(key, ids, n_added)``: ``ids`` is the final context (last
    ``block`` tokens), ``n_added`` the tokens appended.  The per-prompt state (one row per prompt) is
    materialised after every round, so each round plans against a plain
    table and lineage never grows."""
    index, other = candidate_index(model, vocab, k, p, temperature, alpha)
    index = cut_lineage(index, "candidates")
    other = cut_lineage(other.agg(F.first("tokens").alias("_ot"), F.first("cum").alias("_oc")), "candidates-unseen")  # one row
    state = cut_lineage(prompts.select(key, last_n(ids, block).alias("ids"), F.lit(0).alias("n_added")), "generate")
    for step in range(n_new):
        cur = state.withColumn("prev", F.element_at("ids", -1)).withColumn("_step", F.lit(step))
        at = attach_scalars(cur.join(index, "prev", "left"), other)
        known = F.col("tokens").isNotNull()
        u = keyed_uniform(seed, "draw", key, "_step")
        st = at.withColumn("next", F.when(known, draw("tokens", "cum", u)).otherwise(draw("_ot", "_oc", u)))
        add = F.col("next").isNotNull() & (F.col("next") != F.lit(end_id))
        new_ids = F.when(add, last_n(F.concat("ids", F.array(F.col("next"))), block)).otherwise(F.col("ids"))
        state = st.select(key, new_ids.alias("ids"), (F.col("n_added") + F.when(add, 1).otherwise(0)).alias("n_added"))
        if (step + 1) % lineage_every == 0:
            state = cut_lineage(state, "generate")
    return state
