"""Registered queries of the corpus operators, with DuckDB SQL where SQL can
express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import byte_bpe, chat_format, collocations, exact_dedup, hmm_lm, license_scan, line_dedup, near_dedup, packing, periodic_runs, quality, substring_dedup, topk_search
from tokenloom.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return topk_search.topk_search(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256)


ORACLE["op1_topk_search"] = topk_search.ORACLE_SQL


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, read(spark, sf_dir, "labels"))).drop("row")


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return license_scan.license_scan(docs, license_scan.train(docs))


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, max_len=2048)


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return byte_bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False)


@query
def op6_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.hmm_scores(read(spark, sf_dir, "documents"))


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


ORACLE["op7_exact_dedup"] = exact_dedup.ORACLE_SQL


@query
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(read(spark, sf_dir, "documents"), shingle=4, percent=80).drop("h1", "h2", "class_key")


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(read(spark, sf_dir, "documents"), min_docs=10, min_code_points=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op9_line_dedup"] = line_dedup.ORACLE_SQL


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(read(spark, sf_dir, "documents"), window=20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"), min_count=100, max_words=5, top=2000)


ORACLE["op11_collocations"] = collocations.ORACLE_SQL


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic_runs.report(periodic_runs.looped(docs), min_length=12)


@query
def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.read_back(chat_format.format_turns(chat_format.with_probe(read(spark, sf_dir, "conversations"))))


ORACLE["op13_chat_format"] = chat_format.ORACLE_SQL


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
