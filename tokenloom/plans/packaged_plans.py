"""Registered queries: the packaged-trainer data path (K4 random split ->
tokenize with mask -> P5 concatenation per shard and batch -> P6 fixed chunks) and the UDF surface (UD1-UD3)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tokenloom.functions import arrays as A
from tokenloom.operators import filters, pack, splits, tokenizer, udf
from tokenloom.operators.positions import stage_rows
from tokenloom.plans import sqlparts as S
from tokenloom.plans.registry import register, table
from tokenloom.session import cut_lineage

TEST, SEED, VOCAB = 0.0015, 42, 8192
ROWS, SHARDS, CHUNK = 1_000_000, 8, 1024

BASE = f"""WITH hd AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
nn AS (SELECT count(*) AS n FROM hd),
rk AS (SELECT doc_id, text, row_number() OVER (ORDER BY {S.khash(SEED, 'split', 'doc_id')}, doc_id) - 1 AS shuffle_rank FROM hd),
sp AS (SELECT rk.*, CASE WHEN shuffle_rank < CAST(ceil(n * {TEST}) AS BIGINT) THEN 'test' ELSE 'train' END AS split,
              shuffle_rank - CAST(ceil(n * {TEST}) AS BIGINT) AS r FROM rk, nn),
hw AS (SELECT doc_id, unnest({S.words('text')}) AS token, generate_subscripts({S.words('text')}, 1) AS k FROM hd),
cnt AS (SELECT token, count(*) AS c FROM hw WHERE token NOT IN ('<|endoftext|>', '<pad>') GROUP BY token),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY c DESC, token) + 1 AS INTEGER) AS id FROM cnt
          QUALIFY row_number() OVER (ORDER BY c DESC, token) <= {VOCAB - 2}),
ti AS (SELECT sp.doc_id, sp.r, coalesce(list(v.id ORDER BY hw.k) FILTER (WHERE v.id IS NOT NULL), CAST([] AS INTEGER[])) AS ids
       FROM sp LEFT JOIN hw USING (doc_id) LEFT JOIN vocab v ON v.token = hw.token WHERE sp.split = 'train' GROUP BY sp.doc_id, sp.r),
tn AS (SELECT count(*) AS n, count(*) // {SHARDS} AS dv, count(*) % {SHARDS} AS md FROM ti),
sh AS (SELECT ti.*, CASE WHEN r < (dv + 1) * md THEN r // (dv + 1) ELSE md + (r - (dv + 1) * md) // greatest(dv, 1) END AS shard, dv, md FROM ti, tn),
sb AS (SELECT sh.*, (r - CASE WHEN shard < md THEN shard * (dv + 1) ELSE (dv + 1) * md + (shard - md) * dv END) // {ROWS} AS batch FROM sh)"""


def _split(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return cut_lineage(splits.split_random(d, TEST, SEED, ["doc_id"]))


def _tokenized_train(spark, sf):
    sp = _split(spark, sf)
    v = cut_lineage(tokenizer.build_vocab(sp, "text", VOCAB))
    n_test = sp.filter(F.col("split") == "test").count()  # small scalar
    train = sp.filter(F.col("split") == "train").withColumn("row_no", F.col("shuffle_rank") - F.lit(n_test))
    enc = tokenizer.encode(train.select("doc_id", "row_no", "text"), v, "doc_id", "text", out="input_ids", carry=["row_no"])
    enc = tokenizer.attention_mask(enc, "input_ids")
    return stage_rows(enc, "packaged-train"), train.count()


@register("k4_split_random", sql=f"{BASE} SELECT doc_id, split, shuffle_rank FROM sp")
def k4_split_random(spark, sf):
    return _split(spark, sf).select("doc_id", "split", "shuffle_rank")


@register("p5_concat_batches", sql=f"""{BASE}
SELECT doc_id, CAST(shard AS INTEGER) AS shard, CAST(batch AS BIGINT) AS batch, CAST(len(ids) AS INTEGER) AS n_ids,
       CAST(coalesce(sum(len(ids)) OVER (PARTITION BY shard, batch ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset,
       md5(array_to_string(ids, ',')) AS ids_md5, CAST(len(ids) AS BIGINT) AS mask_sum FROM sb""")
def p5_concat_batches(spark, sf):
    enc, n = _tokenized_train(spark, sf)
    cc = pack.concat_batches(enc, "row_no", "input_ids", ROWS, SHARDS, n_rows=n)
    return cc.select("doc_id", "shard", "batch", F.size("input_ids").alias("n_ids"), "offset", A.ints_md5("input_ids").alias("ids_md5"),
                     F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("mask_sum"))


@register("p6_chunk_fixed", sql=f"""{BASE},
cc AS (SELECT CAST(shard AS INTEGER) AS shard, CAST(batch AS BIGINT) AS batch, flatten(list(ids ORDER BY r)) AS ids FROM sb GROUP BY shard, batch),
ch AS (SELECT shard, batch, ids, unnest(range(len(ids) // {CHUNK})) AS chunk FROM cc)
SELECT shard, batch, CAST(chunk AS BIGINT) AS chunk, md5(array_to_string(ids[chunk * {CHUNK} + 1: (chunk + 1) * {CHUNK}], ',')) AS ids_md5,
       CAST({CHUNK} AS INTEGER) AS mask_sum FROM ch""")
def p6_chunk_fixed(spark, sf):
    enc, n = _tokenized_train(spark, sf)
    cc = pack.concat_batches(enc, "row_no", "input_ids", ROWS, SHARDS, n_rows=n)
    ch = pack.pack_blocks(cc, "input_ids", ["row_no"], ["shard", "batch"], block=CHUNK).withColumnRenamed("block_id", "chunk")
    ch = tokenizer.attention_mask(ch, "tokens")
    mask = F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x)
    return ch.select("shard", "batch", "chunk", A.ints_md5("tokens").alias("ids_md5"), mask.alias("mask_sum"))


# --- UD: user-defined functions ------------------------------------------------

@register("ud1_filter_udf", sql=f"SELECT doc_id FROM documents WHERE lang IN ('de', 'fr') AND {S.count_lit('text', '.')} > 20")
def ud1_filter_udf(spark, sf):
    """UD1 with a caller-side pandas predicate (Arrow batches): German or
    French documents with more than 20 full stops."""
    return filters.filter_udf(table(spark, sf, "documents"), lambda lang, text: lang.isin(["de", "fr"]) & (text.str.count(r"\.") > 20),
                              ["lang", "text"]).select("doc_id")


@register("ud2_map_rows", sql=f"SELECT doc_id, CAST(length({S.strip('text')}) AS BIGINT) AS n_stripped FROM documents")
def ud2_map_rows(spark, sf):
    """UD2: a row mapper in caller Python (``str.strip``); the source text
    column is replaced by the mapped one."""

    def fn(b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": b["doc_id"], "n_stripped": b["text"].fillna("").str.strip().str.len().astype("int64")})

    return udf.map_rows(table(spark, sf, "documents").select("doc_id", "text"), fn, "doc_id long, n_stripped long")


@register("ud3_map_batches", sql=f"""
WITH w AS (SELECT doc_id, unnest({S.words('text')}) AS word FROM documents)
SELECT doc_id, word, count(*) AS n FROM w GROUP BY doc_id, word HAVING count(*) >= 20""")
def ud3_map_batches(spark, sf):
    """UD3: a batched n -> m mapper in caller Python (frequent words per
    document), in the scan's own partitions."""

    def fn(b: pd.DataFrame) -> pd.DataFrame:
        ex = b.assign(word=b["text"].fillna("").str.split()).explode("word").dropna(subset=["word"])
        c = ex.groupby(["doc_id", "word"]).size().reset_index(name="n")
        return c[c["n"] >= 20].astype({"n": "int64"})

    d = table(spark, sf, "documents").select("doc_id", "text")
    return udf.map_batches(d, fn, "doc_id long, word string, n long", key="doc_id")
