"""Stream equals batch (ST1, ST5), resume (ST3), guards, and the driver contract."""

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import augment, metrics
from tokenloom.sources import sinks
from tokenloom.streaming import early_stop, prepare


def test_stream_prepare_equals_batch_and_resumes(spark, tmp_path):
    docs = [(i, ". ".join(f"sentence {i} {j} words here" for j in range(6)) + ".") for i in range(40)]
    src = str(tmp_path / "src")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(src)
    schema = spark.read.parquet(src).schema
    s = prepare.stream_prepare(prepare.stream_corpus(spark, src, schema), p=0.2, seed=5)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    q1 = prepare.run_available(s, out, ck)
    prepare.run_available(s, out, ck)  # resume: nothing new
    streamed = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(out).collect())
    batch = sorted((r["doc_id"], r["text"]) for r in augment.prepare_documents(spark.read.parquet(src), p=0.2, seed=5).collect())
    assert streamed == batch
    prog = prepare.progress_rows(spark, q1).collect()
    assert sum(r["num_input_rows"] for r in prog) == 40


def test_stream_early_stop_equals_batch(spark, tmp_path):
    seq = [3.0, 2.0, 2.5, 2.5, 1.0, 1.5, 1.5, 1.5, float("nan"), 0.5]
    rows = [(r, i * 10, i, v + r) for r in (1, 2) for i, v in enumerate(seq)]
    df = spark.createDataFrame(rows, "run_id long, step long, eval_idx long, loss double")
    src = str(tmp_path / "ev")
    for lo, hi in ((0, 4), (4, 7), (7, 10)):  # arrival order per run
        df.filter((F.col("eval_idx") >= lo) & (F.col("eval_idx") < hi)).coalesce(1).write.mode("append").parquet(src)
    s = prepare.stream_corpus(spark, src, df.schema, max_files_per_trigger=1)
    out = str(tmp_path / "o")
    prepare.run_available(early_stop.stream_early_stop(s, 2), out, str(tmp_path / "c"))
    st = {(r["run_id"], r["step"]): r for r in spark.read.parquet(out).collect()}
    bt = metrics.patience(metrics.running_best(df, "run_id", "step", "loss"), "run_id", "step", "eval_idx")
    stops = {r["run_id"]: r["stop_step"] for r in metrics.early_stop(bt, 2).collect()}
    for r in bt.collect():
        x = st[(r["run_id"], r["step"])]
        assert (x["best_before"], x["improved"], x["patience_before"], x["patience_after"]) == (
            r["best_before"], r["improved"], r["patience_before"], r["patience_after"])
        assert x["stop"] == (r["step"] == stops[r["run_id"]])


def test_require_nonempty_and_write_if_absent(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    with pytest.raises(ValueError):
        sinks.require_nonempty(empty, "prepared corpus")
    with pytest.raises(ValueError):
        sinks.require_nonempty(spark.createDataFrame([(0,)], "n long"), "tokens", "n")
    p = str(tmp_path / "t")
    first = sinks.write_if_absent(spark.range(3), p).count()
    second = sinks.write_if_absent(spark.range(10), p).count()  # present: skipped
    assert (first, second) == (3, 3)


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["lang", "n_pairs", "cross_entropy", "perplexity"]
    assert len(rows) >= 1 and all(r["perplexity"] > 1 for r in rows)
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 100


def test_stage_tables_live_under_checkpoint_dir(spark):
    from tokenloom.session import checkpoint_dir, cut_lineage, ensure_checkpoint_dir, stage_path
    from tokenloom.sources.corpus import spread_small

    d1 = ensure_checkpoint_dir(spark)
    d2 = ensure_checkpoint_dir(spark)
    assert d1 == d2 == checkpoint_dir(spark)  # set once, never nested
    assert stage_path(spark, "x").startswith(d1.rstrip("/") + "/tokenloom-stages/x-")
    df = cut_lineage(spark.range(5), "t")
    assert sorted(r[0] for r in df.collect()) == list(range(5))
    assert "InMemoryFileIndex" in df._jdf.queryExecution().executedPlan().toString() or df.inputFiles()
    one = spark.range(0, 100, numPartitions=1)
    assert spread_small(one).rdd.getNumPartitions() == 1  # off unless a session asks for it
    spark.conf.set("tokenloom.spreadSmallScans", "true")
    try:
        assert spread_small(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.unset("tokenloom.spreadSmallScans")


def test_cluster_without_checkpoint_folder_is_an_error():
    from types import SimpleNamespace

    import pytest

    from tokenloom.session import ensure_checkpoint_dir

    def unset(key):
        raise KeyError(key)

    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=unset)))


def test_early_stop_over_many_arrow_chunks():
    """Steps that arrive out of order, over several Arrow chunks of a run."""
    import math

    import pandas as pd

    from tokenloom.streaming.early_stop import _updater

    class State:
        exists = False

        def update(self, new):
            self.new = new

    loss = [5.0, 4.0, 3.5, 6.0, 6.0, 6.0]
    rows = pd.DataFrame({"run_id": 1, "step": [i * 100 for i in range(6)], "eval_idx": list(range(6)), "loss": loss})
    chunks = [rows.iloc[a : a + 2] for a in (4, 0, 2)]
    out = pd.concat(_updater(3)((1,), iter(chunks), State()))
    assert out["step"].tolist() == [i * 100 for i in range(6)]
    assert out["best_before"].tolist() == [math.inf, 5.0, 4.0, 3.5, 3.5, 3.5]
    assert out["patience_after"].tolist() == [0, 0, 0, 1, 2, 3]
    assert out["stop"].tolist() == [False] * 5 + [True]
