"""Files of stored metrics and checkpoints."""

import os

from pyspark.sql import functions as F

from tokenloom.sources import sinks


def _files(path, end):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(end)]


def test_metric_files_do_not_multiply_with_the_runs(spark, tmp_path):
    path = str(tmp_path / "metrics")
    steps = spark.range(3000).select((F.col("id") % 300).alias("run_id"), F.floor(F.col("id") / 300).alias("step"), F.lit("loss").alias("name"),
                                     F.col("id").cast("double").alias("value"))
    steps = steps.withColumn("run_id", F.when(F.col("run_id") > 0, F.col("run_id")))  # a run without an id
    sinks.append_metrics(steps.filter("step < 4").withColumn("value", F.lit(-1.0)), path, attempt=1)
    sinks.append_metrics(steps, path, attempt=2)
    assert len(_files(path, ".parquet")) < 100
    back = sinks.read_metrics(spark, path).select("run_id", "step", "name", "value")
    assert back.count() == 3000
    assert back.exceptAll(steps).isEmpty() and steps.exceptAll(back).isEmpty()


def test_checkpoint_files_are_written_and_listed(spark, tmp_path):
    path = str(tmp_path / "ckpts")
    names = spark.range(60).select((F.col("id") % 20).alias("run_id"), F.concat(F.lit("checkpoint-"), F.floor(F.col("id") / 20).cast("string")).alias("name"))
    names = names.withColumn("run_id", F.when(F.col("run_id") > 0, F.col("run_id")))
    sinks.write_checkpoint_files(names.withColumn("payload", F.lit("1")), path, per_task=5)
    assert len(_files(path, ".txt")) == 60
    got = sinks.list_checkpoints(spark, path, "*.txt").collect()
    assert sorted(((r["run_id"] or 0), r["name"], r["step"]) for r in got) == sorted((i % 20, f"checkpoint-{i // 20}", i // 20) for i in range(60))


def test_checkpoint_files_need_no_process_each(spark, tmp_path):
    """Hadoop's local file system starts a ``chmod`` for each of a checkpoint's
    folder, file and checksum, 40 ms a checkpoint; the listing agrees with
    ``binaryFile`` on nulls, names that Spark escapes, copies, hidden and empty files."""
    path = str(tmp_path / "catalog")
    odd = [(1, "checkpoint-10", "1"), (1, "checkpoint-10", "2"), (None, "checkpoint-30", None), (-4, "ckpt_step_0000050.pkl", "x"), (2, None, "1"), (3, "a:b/checkpoint-7", "1")]
    many = spark.range(300).select(F.floor(F.col("id") / 30).alias("run_id"), F.concat(F.lit("checkpoint-"), (F.col("id") % 30).cast("string")).alias("name"), F.lit("1").alias("payload"))
    files = spark.createDataFrame(odd, "run_id long, name string, payload string").unionByName(many.withColumn("run_id", F.col("run_id") + 100))
    sinks.write_checkpoint_files(files, path)
    folders = [f for f in os.listdir(path) if f.startswith("run_id=")]
    assert len(_files(path, ".txt")) == 305 and not _files(path, ".crc")[1:] and "run_id=__HIVE_DEFAULT_PARTITION__" in folders
    assert os.listdir(f"{path}/run_id=3") == ["name=a%3Ab%2Fcheckpoint-7"]
    with open(f"{path}/run_id=1/name=checkpoint-10/part-00000.txt") as f:
        assert sorted(f) == ["1\n", "2\n"]
    os.makedirs(f"{path}/_gone/checkpoint-99")
    for at in (f"{path}/_gone/checkpoint-99/a.txt", f"{path}/run_id=3/.checkpoint-98.txt", f"{path}/run_id=3/checkpoint-97.pkl", f"{path}/run_id=3/checkpoint-96.pkl"):
        with open(at, "w") as f:
            f.write("" if "-96" in at else "1")
    for glob in ("*.txt", None):
        got = sinks.list_checkpoints(spark, path, glob)
        want = sinks.list_checkpoints(spark, path, "{*.txt}" if glob else "[cp]*")  # a pattern that binaryFile lists
        got, want = (sorted(map(str, d.collect())) for d in (got, want))
        assert got == want and len(got) == 304 + (glob is None)
