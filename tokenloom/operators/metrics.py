"""Training-metric analytics.

A metric table is ``(run_id, step, loss)``; evaluation rows are a subset of
steps.  Running best and patience are expressed as associative scans
(running min of the loss; running max of the index of the last
improvement), computed by :func:`tokenloom.operators.positions.running` in
quantile buckets, so a run holding a third of all rows still spreads over
all tasks.

Patience counts *evaluations* since the last improvement; the progress line
of the reference prints best and patience **before** the update, so both
the "before" and "after" values are exposed.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.text import zero_padded
from tokenloom.operators.positions import running

INF = float("inf")

# --- fixed values -----------------------------------------------------------
# Checkpoint names of the two trainers: "ckpt_step_" + 7-digit zero-padded
# step + ".pkl", and "checkpoint-" + step.  Run name: prefix "gpt2", time
# stamp yyyyMMdd-HHmmss, label "steps<N>" or "epochs<N>", "bs<batch>",
# "lr<lr>", joined with "-".  Default patience 800 evaluations, evaluation
# every 50 steps, checkpoint every 100 steps, cosine floor 0.5 of the peak.
CKPT_FILE_PREFIX, CKPT_FILE_SUFFIX, CKPT_STEP_DIGITS = "ckpt_step_", ".pkl", 7
CKPT_DIR_PREFIX = "checkpoint-"
RUN_NAME_PREFIX = "gpt2"
DEFAULT_PATIENCE, DEFAULT_EVAL_EVERY, DEFAULT_CKPT_EVERY, DEFAULT_LR_FLOOR = 800, 50, 100, 0.5
# ---------------------------------------------------------------------------


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def eval_every(df: DataFrame, every: int = DEFAULT_EVAL_EVERY, step: str = "step") -> DataFrame:
    """Rows of evaluation steps (``step % every == 0``)."""
    return df.filter(F.col(step) % F.lit(every) == 0)


def running_best(evals: DataFrame, run: str = "run_id", order: str = "step", loss: str = "loss",
                 key_source: DataFrame | None = None) -> DataFrame:
    """W1 + W2: ``best_before`` (+inf before any finite loss) and
    ``best_after``; ``improved`` = strict ``loss < best_before`` (NaN and
    null never improve, as ``nan < x`` is false)."""
    finite = F.when(~F.isnan(loss), F.col(loss))
    d = running(evals, finite, "min", [order], [run], out="_bb", inclusive=False, key_source=key_source)
    d = d.withColumn("best_before", F.coalesce(F.col("_bb"), F.lit(INF))).drop("_bb")
    imp = F.coalesce((F.col(loss) < F.col("best_before")) & ~F.isnan(loss), F.lit(False))
    d = d.withColumn("improved", imp)
    return d.withColumn("best_after", F.when(F.col("improved"), F.col(loss)).otherwise(F.col("best_before")))


def patience(evals: DataFrame, run: str = "run_id", order: str = "step", idx: str = "eval_idx",
             key_source: DataFrame | None = None) -> DataFrame:
    """Evaluations since the last improvement, reset to 0 on one.

    Needs ``improved`` (W2) and a 0-based evaluation index per run.
    ``patience_after`` = idx - last improving idx (idx + 1 before any);
    ``patience_before`` = the previous row's ``patience_after`` (0 first)."""
    mark = F.when(F.col("improved"), F.col(idx))
    d = running(evals, mark, "max", [order], [run], out="_lp", inclusive=False, key_source=key_source)
    d = d.withColumn("_li", F.coalesce(mark, "_lp"))
    after = F.when(F.col("_li").isNull(), F.col(idx) + 1).otherwise(F.col(idx) - F.col("_li"))
    before = F.when(F.col(idx) == 0, F.lit(0)).when(F.col("_lp").isNull(), F.col(idx)).otherwise(F.col(idx) - 1 - F.col("_lp"))
    return d.withColumn("patience_after", after.cast("long")).withColumn("patience_before", before.cast("long")).drop("_li", "_lp")


def early_stop(evals: DataFrame, n: int = DEFAULT_PATIENCE, run: str = "run_id", step: str = "step") -> DataFrame:
    """Per run, the first evaluation step with ``patience_after >= n``
    (null when it never fires)."""
    hit = F.when(F.col("patience_after") >= F.lit(n), F.col(step))
    return evals.groupBy(run).agg(F.min(hit).alias("stop_step"))


def cut_after_stop(df: DataFrame, stops: DataFrame, run: str = "run_id", step: str = "step") -> DataFrame:
    """Rows after the stop step of their run are cut (stops is one row
    per run, broadcast-sized by the number of runs)."""
    j = df.join(stops, run, "left")
    return j.filter(F.col("stop_step").isNull() | (F.col(step) <= F.col("stop_step"))).drop("stop_step")


def checkpoint_events(steps: DataFrame, evals: DataFrame, every: int = DEFAULT_CKPT_EVERY, eval_every_n: int = DEFAULT_EVAL_EVERY,
                      nested: bool = True, save_first: bool = False,
                      run: str = "run_id", step: str = "step") -> DataFrame:
    """Steps that would save a checkpoint.

    ``nested=True`` (pretraining): at an evaluation step, save when it
    improved, or when ``step > 0 and step % every == 0``, so the effective
    period is lcm(eval interval, every).  ``nested=False`` (fine-tuning):
    improvement at an evaluation step, or ``step > 0 and step % every == 0``
    at any step.  ``save_first=True`` (the oldest rule): step 0 is a periodic
    save too.  Output ``(run, step, improved_save, periodic_save)``."""
    e = evals.select(run, step, "improved")
    j = steps.select(run, step).join(e, [run, step], "left")
    is_eval = F.col("improved").isNotNull()
    periodic = F.col(step) % F.lit(every) == 0
    if not save_first:
        periodic = periodic & (F.col(step) > 0)
    if nested:
        periodic = periodic & is_eval
    imp = F.coalesce(F.col("improved"), F.lit(False))
    out = j.select(run, step, imp.alias("improved_save"), periodic.alias("periodic_save"))
    return out.filter(F.col("improved_save") | F.col("periodic_save"))


def checkpoint_names(events: DataFrame, step: str = "step") -> DataFrame:
    """File names the two trainers write: ``ckpt_step_%07d.pkl`` and
    ``checkpoint-<step>``."""
    return events.withColumn(
        "pkl_name", F.concat(F.lit(CKPT_FILE_PREFIX), zero_padded(step, CKPT_STEP_DIGITS), F.lit(CKPT_FILE_SUFFIX))
    ).withColumn("dir_name", F.concat(F.lit(CKPT_DIR_PREFIX), F.col(step).cast("string")))


def latest_checkpoint(ckpts: DataFrame, run: str = "run_id", name: str = "name", step: str = "step",
                      rule: str = "numeric") -> DataFrame:
    """O3: newest checkpoint per run, by **numeric** step (``max_by``) or by
    **lexicographic** name (``max``; right only with zero-padded names)."""
    if rule == "numeric":
        return ckpts.groupBy(run).agg(F.max_by(name, step).alias("latest"))
    return ckpts.groupBy(run).agg(F.max(name).alias("latest"))


def retain_last(ckpts: DataFrame, n: int = 10, run: str = "run_id", step: str = "step") -> DataFrame:
    """Keep the newest ``n`` checkpoints of each run (two-phase top-n,
    see :func:`tokenloom.operators.scores.topk_per_group`)."""
    from tokenloom.operators.scores import topk_per_group

    return topk_per_group(ckpts, [run], [F.col(step).desc()], n, tiebreak=[], rank_col="_r").drop("_r")


def best_value(evals: DataFrame, run: str = "run_id", step: str = "step", loss: str = "loss") -> DataFrame:
    """Minimum finite validation loss of each run and the first step
    reaching it (``min_by`` over ``(loss, step)``, deterministic on ties)."""
    finite = evals.filter(~F.isnan(loss) & F.col(loss).isNotNull())
    return finite.groupBy(run).agg(
        F.min(loss).alias("best_loss"), F.min_by(step, F.struct(F.col(loss), F.col(step))).alias("best_step")
    )


def mean_step_loss(df: DataFrame, keys=("step",), loss: str = "loss", digits: int = 6) -> DataFrame:
    """Mean loss over the micro-batches of a step."""
    return df.groupBy(*_as_list(keys)).agg(F.round(F.avg(loss), digits).alias("mean_loss"))


def loss_curve(train: DataFrame, val: DataFrame, run: str = "run_id", step: str = "step") -> DataFrame:
    """Training curve with the validation value of evaluation steps
    (left equi-join on run and step; both sides co-partitioned by the join)."""
    return train.join(val, [run, step], "left")


def resume_cursor(metrics: DataFrame, run: str = "run_id", step: str = "step") -> DataFrame:
    """Next step = last stored step + 1, per run."""
    return metrics.groupBy(run).agg((F.max(step) + 1).alias("next_step"))


def run_name(runs: DataFrame, ts: str = "started", max_steps: str = "max_steps", epochs: str = "epochs",
             batch: str = "batch", lr: str = "lr", prefix: str = RUN_NAME_PREFIX) -> DataFrame:
    """``<prefix>-<yyyyMMdd-HHmmss>-<steps N | epochs N>-bs<batch>-lr<lr>``."""
    label = F.when(F.col(max_steps) > 0, F.concat(F.lit("steps"), F.col(max_steps).cast("string"))).otherwise(
        F.concat(F.lit("epochs"), F.col(epochs).cast("string"))
    )
    name = F.concat_ws("-", F.lit(prefix), F.date_format(ts, "yyyyMMdd-HHmmss"), label,
                       F.concat(F.lit("bs"), F.col(batch).cast("string")), F.concat(F.lit("lr"), F.col(lr).cast("string")))
    return runs.withColumn("run_name", name)


def lr_schedule(df: DataFrame, step: str = "step", peak: float = 1e-3, warmup=None, total=None, floor: float = DEFAULT_LR_FLOOR,
                out: str = "lr") -> DataFrame:
    """Linear warm-up from 0 to ``peak`` over ``warmup`` steps, then
    cosine decay to ``floor * peak`` over ``total - warmup`` steps.

    ``warmup``/``total`` are ints or column names (per-run values)."""
    w = F.lit(warmup) if isinstance(warmup, int) else F.col(warmup)
    n = F.lit(total) if isinstance(total, int) else F.col(total)
    s = F.col(step).cast("double")
    decay = F.greatest(n - w, F.lit(1)).cast("double")
    t = F.least(s - w, decay)
    cosine = F.lit(0.5) * (F.lit(1.0) + F.cos(F.lit(math.pi) * t / decay))
    decayed = F.lit(peak) * ((F.lit(1.0 - floor)) * cosine + F.lit(floor))
    warm = F.lit(peak) * s / w.cast("double")
    return df.withColumn(out, F.when(s < w, warm).otherwise(decayed))
