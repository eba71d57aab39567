"""ST3: a batch takes as many files as a slice has, so it has as many tasks."""

from glob import glob

from pyspark.sql import functions as F

from tokenloom.plans.io_plans import st3_stream_resume
from tokenloom.session import ensure_checkpoint_dir


def test_batches_do_not_grow_with_the_files(spark, tmp_path):
    text = F.concat(F.repeat(F.lit("Some words, and more. "), 10), F.col("id").cast("string"))
    docs = spark.range(800).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), text.alias("text"))
    docs.repartition(12).write.parquet(str(tmp_path / "documents.parquet"))
    stages = ensure_checkpoint_dir(spark).removeprefix("file:") + "/tokenloom-stages"
    before = set(glob(f"{stages}/resume-*"))
    got = st3_stream_resume(spark, str(tmp_path))
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == list(range(800))
    new = [p for p in glob(f"{stages}/resume-*") if p not in before]
    files = sum(len(glob(f"{p}/*.parquet")) for p in new if "/resume-src" in p)
    batches = sum(len(glob(f"{p}/commits/[0-9]*")) for p in new if "/resume-ckpt" in p)
    assert files > 12 and 3 <= batches <= 7  # one a file before
