"""ST5: per-run best / patience / stop flag on a live metrics stream.

``applyInPandasWithState`` keyed by run: the state is three numbers (best,
last improving evaluation index, stopped), so it never grows with the run.
Evaluations are assumed to arrive in step order per run (the training loop
emits them in order); within a micro-batch they are sorted by step, over all
Arrow chunks of the run, whatever their size and order of arrival.
Output rows equal the batch operators W1-W3 (plus the stop flag of W4).

:func:`run_early_stop` is the form for runs with very many evaluations a
batch: the evaluations of a run are scanned in segments by many tasks
(``positions.running``), only the segments' summaries (least loss, last
improvement, hits) meet per run, and the state of all runs is a small table
written with each batch.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tokenloom.operators.positions import running
from tokenloom.session import cut_lineage

OUT_SCHEMA = (
    "run_id long, step long, eval_idx long, loss double, best_before double, best_after double, "
    "improved boolean, patience_before long, patience_after long, stop boolean"
)
STATE_SCHEMA = "best double, last_imp long, seen long, stopped boolean"


def _updater(patience_limit: int):
    def update(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            best, last_imp, seen, stopped = state.get
        else:
            best, last_imp, seen, stopped = math.inf, -1, 0, False
        out = []
        frames = list(pdfs)
        if frames:
            for r in pd.concat(frames, ignore_index=True).sort_values(["step", "eval_idx"]).itertuples(index=False):
                idx = int(r.eval_idx)
                loss = float(r.loss) if r.loss is not None else math.nan
                before_best = best
                p_before = 0 if idx == 0 else (idx if last_imp < 0 else idx - 1 - last_imp)
                improved = (not math.isnan(loss)) and loss < best
                if improved:
                    best, last_imp = loss, idx
                p_after = idx + 1 if last_imp < 0 else idx - last_imp
                hit = p_after >= patience_limit and not stopped
                stopped = stopped or hit
                out.append((key[0], int(r.step), idx, loss, before_best, best, improved, p_before, p_after, hit))
                seen += 1
        state.update((best, last_imp, seen, stopped))
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT_SCHEMA.split(", ")])

    return update


def stream_early_stop(evals: DataFrame, patience_limit: int = 800, run: str = "run_id") -> DataFrame:
    """Stateful per-run scan over a streaming ``(run_id, step, eval_idx, loss)``."""
    return evals.groupBy(run).applyInPandasWithState(
        _updater(patience_limit), OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )


RUN_STATE = "run_id long, best double, last_imp long, stopped boolean"


def scan_batch(rows: DataFrame, state: DataFrame, patience_limit: int) -> DataFrame:
    """Rows of ``OUT_SCHEMA`` (but ``loss`` as given) for the evaluations of one
    batch, after the state ``RUN_STATE`` of earlier ones.  Both passes scan
    segments of a run, so one run may hold most rows."""
    order, loss = ["step", "eval_idx"], F.col("loss")
    real = F.coalesce(~F.isnan("loss"), F.lit(False))
    d = running(rows, F.when(real, loss), "min", order, ["run_id"], out="_least", inclusive=False)
    d = d.join(state, "run_id", "left").withColumn("best_before", F.coalesce(F.least("best", "_least"), F.lit(math.inf)))
    d = d.withColumn("improved", real & F.coalesce(loss < F.col("best_before"), F.lit(False)))
    d = d.withColumn("best_after", F.when(F.col("improved"), loss).otherwise(F.col("best_before")))
    d = running(d.drop("_least", "best"), F.when(F.col("improved"), F.col("eval_idx")), "max", order, ["run_id"], out="_imp", inclusive=False)
    last = F.greatest("last_imp", "_imp")  # of earlier evaluations; null: none
    now = F.when(F.col("improved"), F.col("eval_idx")).otherwise(last)
    idx = F.col("eval_idx")
    d = d.withColumn("patience_before", F.when(idx == 0, F.lit(0)).when(last.isNull(), idx).otherwise(idx - 1 - last).cast("long"))
    d = d.withColumn("patience_after", F.when(now.isNull(), idx + 1).otherwise(idx - now).cast("long"))
    d = d.withColumn("_hit", F.col("patience_after") >= F.lit(patience_limit))
    first = d.filter("_hit").groupBy("run_id").agg(F.min(F.struct("step", "eval_idx")).alias("_first"))
    d = d.join(first, "run_id", "left")
    stop = F.col("_hit") & ~F.coalesce("stopped", F.lit(False)) & (F.struct("step", "eval_idx") == F.col("_first"))
    d = d.withColumn("stop", F.coalesce(stop, F.lit(False)))
    return d.select("run_id", "step", "eval_idx", "loss", "best_before", "best_after", "improved", "patience_before", "patience_after", "stop")


def next_state(out: DataFrame, state: DataFrame) -> DataFrame:
    """State of every run after a batch: its summary joined with the state before."""
    seen = out.groupBy("run_id").agg(
        F.min(F.when(F.col("improved"), F.col("loss"))).alias("_b"), F.max(F.when(F.col("improved"), F.col("eval_idx"))).alias("_i"), F.max("stop").alias("_s")
    )
    return state.join(seen, "run_id", "full").select(
        "run_id", F.least("best", "_b").alias("best"), F.greatest("last_imp", "_i").alias("last_imp"),
        (F.coalesce("stopped", F.lit(False)) | F.coalesce("_s", F.lit(False))).alias("stopped"),
    )


def _state_before(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    from tokenloom.sources.sinks import path_exists

    if batch_id > 0 and path_exists(spark, f"{path}/state/batch={batch_id - 1}"):
        return spark.read.parquet(f"{path}/state/batch={batch_id - 1}")
    return spark.createDataFrame([], RUN_STATE)


def run_early_stop(evals: DataFrame, path: str, checkpoint: str, patience_limit: int = 800):
    """Process all available evaluations ``(run_id, step, eval_idx, loss)`` and
    stop; the same checkpoint and path resume.  Rows under ``path/rows``, the
    runs' state after each batch under ``path/state``.  A replayed batch starts
    from the state of the batch before it and overwrites its own output; the
    states before that are removed."""
    from tokenloom.sources.sinks import drop_output

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = _state_before(spark, path, batch_id)
        rows = cut_lineage(batch.select("run_id", "step", "eval_idx", "loss"), "stream-evals")
        scan_batch(rows, state, patience_limit).write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        out = spark.read.parquet(f"{path}/rows/batch={batch_id}")
        next_state(out, state).write.mode("overwrite").parquet(f"{path}/state/batch={batch_id}")
        if batch_id > 1:
            drop_output(spark, f"{path}/state/batch={batch_id - 2}")

    q = evals.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
