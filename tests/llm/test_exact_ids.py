"""Null ids beside ids above 2^53 in one partition: no operator may round them."""

import os

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tokenloom.llm import byte_bpe, collocations, exact_dedup, hmm_lm, license_scan, line_dedup, near_dedup, packing, periodic_runs, quality, substring_dedup, topk_search

BIG = [(1 << 53) + 1, (1 << 53) + 3, (1 << 53) + 5]
LONG = " ".join(f"w{i}" for i in range(40))
TEXTS = {None: "no id here", BIG[0]: LONG, BIG[1]: LONG + " end", BIG[2]: "other words\nThis file is released under the MIT License."}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t), "a", "b", "c", "d", "e") for i, t in TEXTS.items()]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, cut string, th string, key string, node string"
    return spark.createDataFrame(rows, schema).coalesce(1)


def ids(df):
    return sorted((r["doc_id"] for r in df.collect()), key=lambda x: (x is not None, x or 0))


ALL = [None, *BIG]


def test_row_operators(docs):
    assert ids(packing.pack_documents(docs, P.path("word_bpe_49k.json"), 1, 2048)) == ALL
    assert ids(byte_bpe.encode_documents(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, with_ids=False)) == ALL
    assert ids(hmm_lm.hmm_scores(docs, rounds=1)) == ALL
    assert ids(line_dedup.line_dedup(docs)) == ALL
    assert ids(periodic_runs.report(docs.select("doc_id", "text"))) == ALL
    assert collocations.collocations(docs, min_count=2).count() > 0


def test_scan_and_quality(spark, docs):
    labels = spark.createDataFrame([(i, n % 2, 0) for n, i in enumerate(BIG)], "doc_id long, quality int, toxic int")
    assert ids(quality.score(docs, quality.train(docs, labels))) == ALL
    found = license_scan.license_scan(docs, license_scan.train(docs)).collect()
    assert {r["doc_id"] for r in found} == {BIG[2]}


def test_dedup(docs):
    assert ids(exact_dedup.exact_dedup(docs)) == ALL
    near = {r["doc_id"]: (r["component_id"], r["kept"]) for r in near_dedup.near_dedup(docs).collect()}
    assert near == {None: (None, True), BIG[0]: (BIG[0], True), BIG[1]: (BIG[0], False), BIG[2]: (BIG[2], True)}
    cut = {r["doc_id"]: r["n_removed"] for r in substring_dedup.substring_dedup(docs).collect()}
    assert cut == {None: 0, BIG[0]: 0, BIG[1]: 40, BIG[2]: 0}


def test_topk(spark):
    vecs = spark.createDataFrame([(i, [float(n), 1.0]) for n, i in enumerate([*BIG, None])], "vec_id long, embedding array<double>").coalesce(1)
    got = topk_search.topk_search(vecs, vecs.where(F.col("vec_id") == BIG[0]), k=2)
    assert sorted(r["vec_id"] for r in got.collect()) == BIG[1:]


def test_pipeline(spark, docs, tmp_path):
    near = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path))
    assert near.columns == docs.columns and ids(near) == [None, BIG[0], BIG[2]]
    assert ids(corpus_pipeline.drop_exact_copies(spark, docs, str(tmp_path))) == ALL
    cut = corpus_pipeline.cut_repeats(spark, docs, str(tmp_path))
    assert cut.columns == docs.columns and {r["doc_id"]: r["text"] for r in cut.collect()} == {**TEXTS, BIG[1]: "end"}
    assert ids(corpus_pipeline.pack(spark, docs, str(tmp_path))) == ALL
    assert os.path.isdir(tmp_path)
