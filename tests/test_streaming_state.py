"""Streams whose results must not depend on files, batches, replays or tasks."""

import math
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tokenloom.operators import augment, metrics
from tokenloom.operators.positions import running
from tokenloom.streaming import early_stop, prepare

DOCS = "doc_id long, text string, passed boolean"


def _records(spark, n=230):
    rnd = random.Random(3)
    return spark.createDataFrame([(i * 3, None if rnd.random() < 0.05 else f"t{i}", rnd.random() < 0.8) for i in range(n)], DOCS)


@pytest.mark.parametrize("files", [1, 3, 50])
def test_chunks_do_not_depend_on_files(spark, tmp_path, files):
    """Equal to the batch operator with one batch a file, restarted in between."""
    df = _records(spark)
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    edges = [690 * i // files for i in range(files + 1)]
    for step, (lo, hi) in enumerate(zip(edges, edges[1:])):
        df.filter((F.col("doc_id") >= lo) & (F.col("doc_id") < hi)).coalesce(1).write.mode("append").parquet(src)
        if step in (0, files // 2, files - 1):
            prepare.stream_chunks(prepare.stream_corpus(spark, src, df.schema, max_files_per_trigger=1), out, ck, passed="passed", chunk_size=20)
    rows = spark.read.parquet(f"{out}/rows")
    assert rows.groupBy("chunk_id").count().filter("count > 20").count() == 0
    got = prepare.stream_chunk_texts(rows, 20).collect()
    texts = df.withColumn("passed", F.col("passed") & F.col("text").isNotNull())
    want = augment.assemble_chunks(texts, "doc_id", "text", "passed", 20, " ").select("chunk_id", "text", "n_records", "is_full").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_a_replayed_batch_writes_the_same_chunks(spark, tmp_path):
    df = _records(spark, 100)
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    for lo, hi in ((0, 90), (90, 200), (200, 300)):
        df.filter((F.col("doc_id") >= lo) & (F.col("doc_id") < hi)).coalesce(1).write.mode("append").parquet(src)
        prepare.stream_chunks(prepare.stream_corpus(spark, src, df.schema), out, ck, passed="passed", chunk_size=16)
    before = sorted(map(tuple, spark.read.parquet(f"{out}/rows").collect()), key=str)
    for f in (tmp_path / "ck" / "commits").glob("*2*"):  # as if the driver had died before it committed the last batch
        f.unlink()
    prepare.stream_chunks(prepare.stream_corpus(spark, src, df.schema), out, ck, passed="passed", chunk_size=16)
    assert sorted(map(tuple, spark.read.parquet(f"{out}/rows").collect()), key=str) == before


def test_resume_after_a_failure_in_mid_run(spark, tmp_path):
    """Batches 0 and 1 are committed, batch 2 fails in one of its tasks; a new
    file comes before the restart.  No row is lost or doubled."""
    df = spark.createDataFrame([(i, f"text {i}") for i in range(80)], "doc_id long, text string")
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    for lo in (0, 20, 40):
        df.filter((F.col("doc_id") >= lo) & (F.col("doc_id") < lo + 20)).coalesce(1).write.mode("append").parquet(src)
    s = prepare.stream_corpus(spark, src, df.schema, max_files_per_trigger=1)
    bad = F.when(F.col("doc_id") == 59, F.raise_error(F.lit("injected")).cast("string")).otherwise(F.col("text"))
    with pytest.raises(StreamingQueryException):
        prepare.run_available(s.repartition(4, "doc_id").withColumn("text", bad), out, ck)
    assert spark.read.parquet(out).count() == 40
    df.filter("doc_id >= 60").coalesce(1).write.mode("append").parquet(src)
    prepare.run_available(s.repartition(4, "doc_id").withColumn("text", F.col("text")), out, ck)
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, df.collect()))


def _evals(spark, runs):
    rnd = random.Random(8)
    rows = []
    for run, n in runs.items():
        for i in range(n):
            loss = rnd.choice([None, math.nan, 5.0, 5.0, rnd.random() * 6, 6 - i / n])
            rows.append((run, i * 10, i, loss))
    return spark.createDataFrame(rows, "run_id long, step long, eval_idx long, loss double")


@pytest.mark.parametrize("limit", [3, 8, 10_000])
def test_early_stop_in_segments_equals_batch(spark, tmp_path, limit):
    """One run holds 90 % of the rows; three deliveries, one of them replayed."""
    df = _evals(spark, {1: 1800, 2: 60, 3: 60, 4: 79, 5: 1})
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    for lo, hi in ((0, 700), (700, 1400), (1400, 9999)):
        df.filter((F.col("eval_idx") >= lo) & (F.col("eval_idx") < hi)).repartition(4).write.mode("append").parquet(src)
        early_stop.run_early_stop(prepare.stream_corpus(spark, src, df.schema), out, ck, limit)
    for f in (tmp_path / "ck" / "commits").glob("*2*"):
        f.unlink()
    early_stop.run_early_stop(prepare.stream_corpus(spark, src, df.schema), out, ck, limit)
    got = spark.read.parquet(f"{out}/rows")
    want = metrics.patience(metrics.running_best(df, "run_id", "step", "loss"), "run_id", "step", "eval_idx")
    stops = metrics.early_stop(want, limit)
    want = want.join(stops, "run_id").withColumn("stop", F.coalesce(F.col("step") == F.col("stop_step"), F.lit(False)))
    cols = ["run_id", "step", "best_before", "best_after", "improved", "patience_before", "patience_after", "stop"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_a_hot_run_is_scanned_by_many_tasks(spark):
    df = _evals(spark, {1: 4000, 2: 100})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would else join in one partition
    try:
        d = running(df, "loss", "min", ["step", "eval_idx"], ["run_id"], out="x", inclusive=False)
        counts = [r["count"] for r in d.filter("run_id = 1").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(counts) >= 4 and max(counts) < 2400


def test_cut_after_stop(spark):
    df = spark.createDataFrame([(r, s) for r in (1, 2) for s in range(5)], "run_id long, step long")
    stops = spark.createDataFrame([(1, 2), (2, None)], "run_id long, stop_step long")
    got = sorted(map(tuple, metrics.cut_after_stop(df, stops).collect()))
    assert got == [(1, 0), (1, 1), (1, 2), *((2, s) for s in range(5))]
