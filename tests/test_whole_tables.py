"""Queries that have to read whole tables and keep every row."""

from pyspark.sql import functions as F

from tokenloom.operators import scores
from tokenloom.plans import io_plans  # noqa: F401  (registers the queries)

SF = "/root/testdata/sf0.001"


def test_lookup_vectors_keeps_ids_without_a_vector(spark):
    ids = spark.createDataFrame([(0, 0, 7), (0, 1, 8), (1, 0, 7), (1, 1, 9)], "doc_id long, pos int, token int")
    vectors = spark.createDataFrame([(7, 0.5), (9, 1.5), (3, 2.5)], "vec_id long, e1 double")
    out = scores.lookup_vectors(ids, vectors)
    assert sorted((r.doc_id, r.pos, r.token, r.e1) for r in out.collect()) == [(0, 0, 7, 0.5), (0, 1, 8, None), (1, 0, 7, 0.5), (1, 1, 9, 1.5)]
    assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString()


def test_bpe_encodes_every_document(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    alphabet = docs.select(F.explode(F.regexp_extract_all(F.regexp_replace("text", r"(?U)\s", ""), F.lit("(?s)."), F.lit(0)))).distinct().count()
    monkeypatch.setattr(io_plans, "BPE_VOCAB", 2 + alphabet + 1)  # one merge: encoding is the matter here
    monkeypatch.setattr(io_plans, "_TOKENIZERS", {})
    out = io_plans.t4_encode_bpe(spark, SF)
    n_chars = F.length(F.regexp_replace("text", r"(?U)\s", ""))
    want = {r.doc_id: r.n for r in docs.select("doc_id", n_chars.alias("n")).collect()}
    got = {r.doc_id: r.n_ids for r in out.collect()}
    assert got.keys() == want.keys()
    assert all(want[i] / 2 <= n <= want[i] for i, n in got.items()) and any(n < want[i] for i, n in got.items())
