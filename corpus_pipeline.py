"""Training-data pipeline: quality, exact dedup, near-dedup, substring dedup,
packing.  Every stage but the last returns the columns of ``documents``; each
is written as Parquet and read again for the next one.

Null texts are empty texts; rows without doc_id are kept or dropped like
others; extra columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import exact_dedup, near_dedup, packing, quality, substring_dedup
from tokenloom.llm.common import LOWER, UPPER, read, text_hashes
from tokenloom.session import cut_lineage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("predicted = 1").select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts; of rows that also share the
    doc_id, one."""
    kept = cut_lineage(exact_dedup.exact_dedup(docs).where("kept").select(F.col("doc_id").alias("kept_id"), "text_sha256"), "kept")
    sha = F.sha2(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), 256)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("row_id"), sha.alias("sha"))
    same = (F.col("sha") == F.col("text_sha256")) & F.col("row_id").eqNullSafe(F.col("kept_id"))
    stay = rows.join(kept, same, "left_semi")
    if kept.count() > kept.select("text_sha256").distinct().count():  # only where rows repeat their doc_id too
        stay = stay.dropDuplicates(["sha"])
    return stay.select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; of rows that also share
    doc_id and text, one."""
    near = cut_lineage(near_dedup.near_dedup(docs, shingle=5, percent=80).select("doc_id", "h1", "h2", "kept", "class_key"), "near-kept")
    gone = near.where("not kept").select("doc_id", "h1", "h2").distinct().alias("gone")
    repeated = near.where("kept and class_key is not null").groupBy("doc_id", "h1", "h2").count().where("count > 1").alias("repeated")
    # A row is known by its id and text: ids alone can be null or have several texts.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    h1, h2 = text_hashes(F.coalesce("row.text", F.lit("")))
    rows = docs.select(row).select("row", F.col("row.doc_id").cast("long").alias("doc_id"), h1, h2).alias("rows")

    def same(other: str):
        ids = F.col("rows.doc_id").eqNullSafe(F.col(f"{other}.doc_id"))
        return ids & (F.col("rows.h1") == F.col(f"{other}.h1")) & (F.col("rows.h2") == F.col(f"{other}.h2"))

    stay = rows.join(gone, same("gone"), "left_anti").alias("rows")
    if not repeated.isEmpty():
        one = stay.join(repeated, same("repeated"), "left_semi").dropDuplicates(["doc_id", "h1", "h2"])
        stay = stay.join(repeated, same("repeated"), "left_anti").unionByName(one)
    return stay.select("row.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that occur earlier; others stay as they are."""
    out = substring_dedup.substring_dedup(docs)
    text = F.when(F.col("n_removed") > 0, F.col("text")).otherwise(F.col("row.text"))
    new = {"text": text.alias("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*[new.get(c, F.col(f"row.`{c}`")) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, max_len=2048)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("packing", pack),
]

#: Quality and tokens cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
