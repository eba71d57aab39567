"""The documents as a stream: the table is one file or a folder of files."""

import pytest

from tokenloom.plans import io_plans

TEXT = "One two three four five six seven. Eight nine ten eleven twelve. Thirteen fourteen fifteen sixteen. Seventeen eighteen."


@pytest.mark.parametrize("files", [1, 3])
def test_folder_of_files(spark, tmp_path, files):
    docs = spark.createDataFrame([(i, "en", f"{TEXT} {i}") for i in range(9)], "doc_id long, lang string, text string")
    docs.repartition(files).write.parquet(str(tmp_path / "documents.parquet"))
    _check(spark, str(tmp_path))


def test_single_file(spark, tmp_path):
    docs = spark.createDataFrame([(i, "en", f"{TEXT} {i}") for i in range(9)], "doc_id long, lang string, text string")
    docs.toPandas().to_parquet(str(tmp_path / "documents.parquet"))
    _check(spark, str(tmp_path))


def _check(spark, sf):
    assert sorted(r["doc_id"] for r in io_plans.s4_stream_corpus(spark, sf).collect()) == list(range(9))
    assert sorted(r["doc_id"] for r in io_plans.st1_stream_prepare(spark, sf).collect()) == list(range(9))
    assert io_plans.st4_stream_progress(spark, sf).agg({"num_input_rows": "sum"}).first()[0] == 9
