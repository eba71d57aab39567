"""Registered queries over run metrics (W1-W4, W8-W10, G12, J3, O3, K10,
X12, X17, X22, X23).  The driver's ``events`` table is the metric stream:
run = ``user_id``, order = ``(ts, event_id)``, loss = ``value``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.functions import structs
from tokenloom.functions import text as T
from tokenloom.operators import metrics
from tokenloom.operators.positions import row_index
from tokenloom.plans.registry import register, table
from tokenloom.session import cut_lineage

EVAL_EVERY, CKPT_EVERY, PATIENCE, KEEP = 5, 10, 3, 3
BATCH, LR_TEXT, PEAK, FLOOR = 8, "5e-05", 1e-3, 0.5


def metric_steps(spark, sf):
    """``(run_id, step, loss, ts)``: step = 0-based position in the run."""
    ev = table(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    d = row_index(ev, ["ts", "event_id"], ["user_id"], out="step", key_source=table(spark, sf, "events").select("ts"))
    return cut_lineage(d.select(F.col("user_id").alias("run_id"), "step", F.col("value").alias("loss"), "ts"))


def evals(spark, sf, steps=None):
    steps = steps if steps is not None else metric_steps(spark, sf)
    e = metrics.eval_every(steps, EVAL_EVERY).withColumn("eval_idx", (F.col("step") / EVAL_EVERY).cast("long"))
    e = cut_lineage(e)
    ks = e.select("step")
    e = metrics.running_best(e, "run_id", "step", "loss", key_source=ks)
    e = metrics.patience(e, "run_id", "step", "eval_idx", key_source=ks)
    return cut_lineage(e)


BASE = f"""WITH ms AS (SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step, value AS loss, ts FROM events),
ev AS (SELECT run_id, step, loss, step // {EVAL_EVERY} AS eval_idx FROM ms WHERE step % {EVAL_EVERY} = 0),
rb AS (SELECT *, coalesce(min(CASE WHEN NOT isnan(loss) THEN loss END) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                          CAST('inf' AS DOUBLE)) AS best_before FROM ev),
im AS (SELECT *, coalesce(loss < best_before AND NOT isnan(loss), false) AS improved FROM rb),
pa AS (SELECT *, max(CASE WHEN improved THEN eval_idx END) OVER (PARTITION BY run_id ORDER BY step ROWS UNBOUNDED PRECEDING) AS li,
                 max(CASE WHEN improved THEN eval_idx END) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lp FROM im),
pt AS (SELECT *, CASE WHEN improved THEN loss ELSE best_before END AS best_after,
                 CAST(CASE WHEN li IS NULL THEN eval_idx + 1 ELSE eval_idx - li END AS BIGINT) AS patience_after,
                 CAST(CASE WHEN eval_idx = 0 THEN 0 WHEN lp IS NULL THEN eval_idx ELSE eval_idx - 1 - lp END AS BIGINT) AS patience_before FROM pa),
ck AS (SELECT ms.run_id, ms.step, coalesce(pt.improved, false) AS improved_save,
              ms.step > 0 AND ms.step % {CKPT_EVERY} = 0 AND pt.improved IS NOT NULL AS periodic_save
       FROM ms LEFT JOIN pt USING (run_id, step)),
cs AS (SELECT * FROM ck WHERE improved_save OR periodic_save)"""


@register("w10_eval_every", sql=f"{BASE} SELECT run_id, step, loss FROM ev")
def w10_eval_every(spark, sf):
    return metrics.eval_every(metric_steps(spark, sf), EVAL_EVERY).select("run_id", "step", "loss")


@register("w1_running_best", sql=f"{BASE} SELECT run_id, step, best_before, best_after FROM pt")
def w1_running_best(spark, sf):
    return evals(spark, sf).select("run_id", "step", "best_before", "best_after")


@register("w2_improved", sql=f"{BASE} SELECT run_id, step, improved FROM pt")
def w2_improved(spark, sf):
    return evals(spark, sf).select("run_id", "step", "improved")


PATIENCE_SQL = f"{BASE} SELECT run_id, step, patience_before, patience_after FROM pt"


@register("w3_patience", sql=PATIENCE_SQL)
def w3_patience(spark, sf):
    return evals(spark, sf).select("run_id", "step", "patience_before", "patience_after")


@register("w4_cut_after_stop", sql=f"""{BASE},
sp AS (SELECT run_id, min(CASE WHEN patience_after >= {PATIENCE} THEN step END) AS stop_step FROM pt GROUP BY run_id)
SELECT ev.run_id, ev.step, ev.loss FROM ev JOIN sp USING (run_id) WHERE stop_step IS NULL OR step <= stop_step""")
def w4_cut_after_stop(spark, sf):
    e = evals(spark, sf)
    return metrics.cut_after_stop(e, metrics.early_stop(e, PATIENCE)).select("run_id", "step", "loss")


@register("w4_early_stop", sql=f"{BASE} SELECT run_id, min(CASE WHEN patience_after >= {PATIENCE} THEN step END) AS stop_step FROM pt GROUP BY run_id")
def w4_early_stop(spark, sf):
    return metrics.early_stop(evals(spark, sf), PATIENCE)


def _ckpts(spark, sf):
    steps = metric_steps(spark, sf)
    e = evals(spark, sf, steps)
    return cut_lineage(metrics.checkpoint_events(steps, e, CKPT_EVERY, EVAL_EVERY, nested=True))


@register("w8_checkpoint_events", sql=f"{BASE} SELECT run_id, step, improved_save, periodic_save FROM cs")
def w8_checkpoint_events(spark, sf):
    return _ckpts(spark, sf)


TUNE_EVERY = 7  # not a multiple of the evaluation interval


@register("w8_checkpoint_every_step", sql=f"""{BASE},
c2 AS (SELECT ms.run_id, ms.step, coalesce(pt.improved, false) AS improved_save, ms.step > 0 AND ms.step % {TUNE_EVERY} = 0 AS periodic_save
       FROM ms LEFT JOIN pt USING (run_id, step))
SELECT run_id, step, improved_save, periodic_save FROM c2 WHERE improved_save OR periodic_save""")
def w8_checkpoint_every_step(spark, sf):
    """W8, fine-tuning rule: the period holds at every step, evaluation or not."""
    steps = metric_steps(spark, sf)
    return metrics.checkpoint_events(steps, evals(spark, sf, steps), TUNE_EVERY, EVAL_EVERY, nested=False)


@register("w8_checkpoint_first_step", sql=f"""{BASE},
c2 AS (SELECT ms.run_id, ms.step, coalesce(pt.improved, false) AS improved_save, ms.step % {CKPT_EVERY} = 0 AND pt.improved IS NOT NULL AS periodic_save
       FROM ms LEFT JOIN pt USING (run_id, step))
SELECT run_id, step, improved_save, periodic_save FROM c2 WHERE improved_save OR periodic_save""")
def w8_checkpoint_first_step(spark, sf):
    """W8, oldest rule: step 0 is a periodic save too."""
    steps = metric_steps(spark, sf)
    return metrics.checkpoint_events(steps, evals(spark, sf, steps), CKPT_EVERY, EVAL_EVERY, nested=True, save_first=True)


@register("x8_prefix_suffix", sql=f"""{BASE},
nm AS (SELECT run_id, step, 'ckpt_step_' || printf('%07d', step) || '.pkl' AS name FROM cs
       UNION ALL SELECT run_id, step, 'checkpoint-' || CAST(step AS VARCHAR) FROM cs
       UNION ALL SELECT run_id, step, 'ckpt_step_' || CAST(step AS VARCHAR) || '.pkl.tmp' FROM cs)
SELECT run_id, name, starts_with(name, 'ckpt_step_') AS has_prefix, ends_with(name, '.pkl') AS has_suffix FROM nm""")
def x8_prefix_suffix(spark, sf):
    """Which of a run's file names are checkpoints of the first trainer."""
    n = metrics.checkpoint_names(_ckpts(spark, sf), "step")
    part = F.concat(F.lit("ckpt_step_"), F.col("step").cast("string"), F.lit(".pkl.tmp"))
    names = n.select("run_id", F.explode(F.array("pkl_name", "dir_name", part)).alias("name"))
    return names.select("run_id", "name", T.has_prefix("name", metrics.CKPT_FILE_PREFIX).alias("has_prefix"),
                        T.has_suffix("name", metrics.CKPT_FILE_SUFFIX).alias("has_suffix"))


@register("w9_retain_last", sql=f"{BASE} SELECT run_id, step FROM (SELECT run_id, step, row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS r FROM cs) WHERE r <= {KEEP}")
def w9_retain_last(spark, sf):
    return metrics.retain_last(_ckpts(spark, sf), KEEP, "run_id", "step").select("run_id", "step")


@register("o3_latest_checkpoint", sql=f"""{BASE},
nm AS (SELECT run_id, step, 'ckpt_step_' || printf('%07d', step) || '.pkl' AS pkl_name, 'checkpoint-' || CAST(step AS VARCHAR) AS dir_name FROM cs)
SELECT run_id, arg_max(dir_name, step) AS latest_numeric, max(dir_name) AS latest_lexicographic, max(pkl_name) AS latest_pkl FROM nm GROUP BY run_id""")
def o3_latest_checkpoint(spark, sf):
    n = metrics.checkpoint_names(_ckpts(spark, sf), "step")
    n = n.withColumn("dir_step", T.step_suffix("dir_name", "-"))  # X10: int(name.split("-")[-1])
    a = metrics.latest_checkpoint(n, "run_id", "dir_name", "dir_step", "numeric").withColumnRenamed("latest", "latest_numeric")
    b = metrics.latest_checkpoint(n, "run_id", "dir_name", "step", "lexicographic").withColumnRenamed("latest", "latest_lexicographic")
    c = metrics.latest_checkpoint(n, "run_id", "pkl_name", "step", "lexicographic").withColumnRenamed("latest", "latest_pkl")
    return a.join(b, "run_id").join(c, "run_id")


@register("k10_resume_cursor", sql=f"{BASE} SELECT run_id, max(step) + 1 AS next_step FROM cs GROUP BY run_id")
def k10_resume_cursor(spark, sf):
    return metrics.resume_cursor(_ckpts(spark, sf), "run_id", "step")


@register("g12_best_value", sql=f"""{BASE}
SELECT run_id, min(loss) AS best_loss, arg_min(step, (loss, step)) AS best_step FROM ev WHERE NOT isnan(loss) AND loss IS NOT NULL GROUP BY run_id""")
def g12_best_value(spark, sf):
    return metrics.best_value(metrics.eval_every(metric_steps(spark, sf), EVAL_EVERY))


@register("j3_loss_curve", sql=f"{BASE} SELECT ms.run_id, ms.step, ms.loss AS train_loss, ev.loss AS val_loss FROM ms LEFT JOIN ev USING (run_id, step)")
def j3_loss_curve(spark, sf):
    steps = metric_steps(spark, sf)
    train = steps.select("run_id", "step", F.col("loss").alias("train_loss"))
    val = metrics.eval_every(steps, EVAL_EVERY).select("run_id", "step", F.col("loss").alias("val_loss"))
    return metrics.loss_curve(train, val)


@register("x12_run_name", sql=f"""{BASE}
SELECT run_id, 'gpt2-' || strftime(min(ts), '%Y%m%d-%H%M%S') || '-steps' || CAST(count(*) AS VARCHAR) || '-bs{BATCH}-lr{LR_TEXT}' AS run_name FROM ms GROUP BY run_id""")
def x12_run_name(spark, sf):
    runs = metric_steps(spark, sf).groupBy("run_id").agg(F.min("ts").alias("started"), F.count(F.lit(1)).alias("max_steps"))
    runs = runs.withColumn("epochs", F.lit(1)).withColumn("batch", F.lit(BATCH)).withColumn("lr", F.lit(LR_TEXT))
    return metrics.run_name(runs).select("run_id", "run_name")


@register("x17_lr_schedule", sql=f"""{BASE},
rn AS (SELECT run_id, count(*) AS n, least(2000, count(*) // 10) AS w FROM ms GROUP BY run_id),
lr AS (SELECT ms.run_id, ms.step, rn.n, rn.w, greatest(rn.n - rn.w, 1) AS d FROM ms JOIN rn USING (run_id))
SELECT run_id, step, round(CASE WHEN step < w THEN {PEAK} * step / w
                  ELSE {PEAK} * ((1 - {FLOOR}) * 0.5 * (1 + cos(pi() * least(step - w, d) / d)) + {FLOOR}) END, 12) AS lr FROM lr""")
def x17_lr_schedule(spark, sf):
    steps = metric_steps(spark, sf)
    n = steps.groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))
    n = n.withColumn("w", F.least(F.lit(2000), (F.col("n") / 10).cast("long")))
    d = metrics.lr_schedule(steps.join(n, "run_id"), "step", PEAK, "w", "n", FLOOR)
    return d.select("run_id", "step", F.round("lr", 12).alias("lr"))


@register("x22_flatten_struct", sql="""
SELECT event_id, 'a.b' AS key, CAST(event_id AS VARCHAR) AS value FROM events
UNION ALL SELECT event_id, 'a.c', CAST(user_id AS VARCHAR) FROM events
UNION ALL SELECT event_id, 'd', CAST(length(props) AS VARCHAR) FROM events""")
def x22_flatten_struct(spark, sf):
    ev = table(spark, sf, "events")
    nested = ev.select("event_id", F.struct(F.struct(F.col("event_id").alias("b"), F.col("user_id").alias("c")).alias("a"),
                                            F.length("props").alias("d")).alias("cfg"))
    return structs.flatten_struct(nested, "cfg", ["event_id"])


@register("x23_merge_config", sql=f"""{BASE}
SELECT run_id, 'batch={BATCH};eval_every={EVAL_EVERY};run=' || CAST(run_id AS VARCHAR) || ';steps=' || CAST(max(step) + 1 AS VARCHAR) AS config
FROM ms GROUP BY run_id""")
def x23_merge_config(spark, sf):
    runs = metric_steps(spark, sf).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.max("step").alias("last"))
    left = F.create_map(F.lit("batch"), F.lit(str(BATCH)), F.lit("eval_every"), F.lit(str(EVAL_EVERY)), F.lit("steps"), F.col("n").cast("string"))
    right = F.create_map(F.lit("steps"), (F.col("last") + 1).cast("string"), F.lit("run"), F.col("run_id").cast("string"))
    merged = structs.merge_config(left, right)
    return runs.select("run_id", structs.render_map(merged).alias("config"))
