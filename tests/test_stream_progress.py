"""Progress counters of runs longer than what Spark keeps."""

from tokenloom.plans import io_plans
from tokenloom.streaming import prepare


def test_progress_of_every_batch_is_recorded(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(20).repartition(10).write.parquet(src)
    s = prepare.stream_corpus(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=1)
    n_files = len(spark.read.parquet(src).inputFiles())
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        prepare.run_available(s, str(tmp_path / "out"), str(tmp_path / "ck"), progress=str(tmp_path / "progress"))
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    rows = spark.read.parquet(str(tmp_path / "progress")).collect()
    assert n_files > 3 and sorted({r.batch_id for r in rows}) == list(range(n_files))
    assert sum(r.num_input_rows for r in rows) == 20


def test_registered_query_reads_the_table(spark):
    rows = io_plans.st4_stream_progress(spark, "/root/testdata/sf0.001").collect()
    assert sum(r.num_input_rows for r in rows) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
