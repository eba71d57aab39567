"""The end-to-end slice: raw documents to validation perplexity.

documents -> strip, length > 100, more than 2 full stops (F2-F4)
-> split on ". ", keyed drop (p = 0.05) and keyed shuffle, rejoin (A1, A3, A5, A6)
-> word-level vocabulary and encode (T2, T4)
-> per-language token streams, offsets, blocks of 64 with one lookahead token (P1, P2, P11)
-> last 20 % of each stream is validation (K2)
-> next-token counts on training pairs (M1)
-> cross-entropy and perplexity on every validation pair, per language (M2, G5, G9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import text as T
from tokenloom.operators import augment, ngram, pack, splits, tokenizer
from tokenloom.plans import sqlparts as S  # noqa: F401  (re-exported for plan modules)
from tokenloom.plans.registry import register, table
from tokenloom.session import cut_lineage

# Parameters of the slice (reference defaults where they exist: p, block,
# validation ratio, seed 42 of the driver's data; vocabulary sized to the data).
SEED = 42
DROP_P = 0.05
MIN_CHARS = 100
MIN_MARKS = 2
BLOCK = 64
VAL_RATIO = 0.2
VOCAB_SIZE = 4096
ALPHA = 1.0
STREAMS = ["lang"]


def prepared_docs(spark: SparkSession, sf_dir: str, materialize: bool = False) -> DataFrame:
    """The prepared corpus stage (the reference's ``input.txt``)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    p = augment.prepare_documents(docs, "doc_id", "text", MIN_CHARS, T.EN_COUNT_DELIM, MIN_MARKS, T.EN_SENTENCE_DELIM, DROP_P, SEED)
    return cut_lineage(p) if materialize else p


def vocab(spark: SparkSession, sf_dir: str, prepared: DataFrame | None = None) -> DataFrame:
    p = prepared if prepared is not None else prepared_docs(spark, sf_dir)
    return tokenizer.build_vocab(p, "text", VOCAB_SIZE)


def encoded_docs(spark: SparkSession, sf_dir: str):
    """Encoded documents and the (materialised, <= VOCAB_SIZE rows) vocabulary.
    The prepared corpus feeds both, so it is checkpointed once."""
    p = prepared_docs(spark, sf_dir, materialize=True)
    v = cut_lineage(vocab(spark, sf_dir, p))
    return tokenizer.encode(p, v, "doc_id", "text", carry=STREAMS), v


def lm_blocks(spark: SparkSession, sf_dir: str, lookahead: int = 1, encoded=None):
    """The block table stage (the reference's token memmap), materialised.
    ``encoded``: an already built ``(enc, vocab)`` pair to reuse (staged rows are not stored again)."""
    enc, v = encoded if encoded is not None else encoded_docs(spark, sf_dir)
    keys = table(spark, sf_dir, "documents").select("doc_id")  # cheap sketch source
    blocks = pack.pack_blocks(enc, "ids", ["doc_id"], STREAMS, BLOCK, lookahead=lookahead, key_source=keys)
    return cut_lineage(blocks), v


def perplexity_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks, v = lm_blocks(spark, sf_dir, lookahead=1)
    bounds = splits.split_ratio(splits.stream_lengths(blocks, STREAMS, BLOCK), VAL_RATIO, STREAMS)
    counts = cut_lineage(ngram.split_pair_counts(ngram.block_pairs(blocks, BLOCK, STREAMS), bounds, STREAMS), "pair-counts")
    model = ngram.fit_from_counts(counts.filter(F.col("split") == "train"), STREAMS)
    val = counts.filter(F.col("split") == "val").withColumnRenamed("c", "mult")
    return ngram.evaluate_model(val, model, tokenizer.vocab_size(v), ALPHA, STREAMS)


# --- DuckDB twin -------------------------------------------------------------

PREPARED_SQL = f"""
docs AS (
  SELECT doc_id, lang, {S.strip("coalesce(text, '')")} AS t FROM documents
),
f AS (
  SELECT doc_id, lang, t FROM docs WHERE length(t) > {MIN_CHARS} AND {S.count_lit('t', '.')} > {MIN_MARKS}
),
sl AS (SELECT doc_id, lang, string_split(t, '. ') AS l FROM f),
s AS (
  SELECT doc_id, lang, unnest(l) AS sent, generate_subscripts(l, 1) - 1 AS pos FROM sl
),
k AS (
  SELECT doc_id, sent, pos, {S.khash(SEED, 'shuffle', 'doc_id', 'pos')} AS h,
         {S.khash(SEED, 'drop', 'doc_id', 'pos')} / 4294967296.0 AS u
  FROM s
),
aug AS (
  SELECT f.doc_id, f.lang,
         coalesce(string_agg(k.sent, '. ' ORDER BY k.h, k.pos) FILTER (WHERE k.u > {DROP_P}), '') AS text
  FROM f LEFT JOIN k USING (doc_id) GROUP BY f.doc_id, f.lang
)"""

VOCAB_SQL = f"""
wl AS (SELECT doc_id, lang, {S.words('text')} AS words FROM aug),
w AS (SELECT doc_id, lang, unnest(words) AS token, generate_subscripts(words, 1) AS wpos FROM wl),
cnt AS (SELECT token, count(*) AS c FROM w WHERE token NOT IN ('<|endoftext|>', '<pad>') GROUP BY token),
vocab AS (
  SELECT token, CAST(row_number() OVER (ORDER BY c DESC, token) + 1 AS INTEGER) AS id FROM cnt
  QUALIFY row_number() OVER (ORDER BY c DESC, token) <= {VOCAB_SIZE - 2}
),
enc AS (SELECT w.doc_id, w.lang, w.wpos, v.id FROM w JOIN vocab v USING (token))"""

STREAM_SQL = f"""
doc_n AS (SELECT a.doc_id, a.lang, count(e.id) AS n FROM aug a LEFT JOIN enc e USING (doc_id) GROUP BY a.doc_id, a.lang),
off AS (SELECT doc_id, lang, n, sum(n) OVER (PARTITION BY lang ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - n AS s FROM doc_n),
kept AS (SELECT lang, sum(n) - sum(n) % {BLOCK} AS k FROM doc_n GROUP BY lang),
tok AS (
  SELECT e.lang, o.s + row_number() OVER (PARTITION BY e.doc_id ORDER BY e.wpos) - 1 AS pos, e.id
  FROM enc e JOIN off o USING (doc_id)
),
kt AS (SELECT t.lang, t.pos, t.id FROM tok t JOIN kept USING (lang) WHERE t.pos < kept.k)"""

PERPLEXITY_SQL = f"""
WITH {PREPARED_SQL}, {VOCAB_SQL}, {STREAM_SQL},
pairs AS (SELECT lang, pos, id AS prev, lead(id) OVER (PARTITION BY lang ORDER BY pos) AS nxt FROM kt),
b AS (SELECT lang, k AS n, k - CAST(floor(k * {VAL_RATIO}) AS BIGINT) AS te FROM kept),
tr AS (SELECT p.lang, prev, nxt FROM pairs p JOIN b USING (lang) WHERE nxt IS NOT NULL AND p.pos + 1 < b.te),
va AS (SELECT p.lang, prev, nxt FROM pairs p JOIN b USING (lang) WHERE nxt IS NOT NULL AND p.pos >= b.te AND p.pos + 1 < b.n),
pc AS (SELECT lang, prev, nxt, count(*) AS c FROM tr GROUP BY lang, prev, nxt),
pv AS (SELECT lang, prev, sum(c) AS cp FROM pc GROUP BY lang, prev),
vv AS (SELECT count(*) + 2 AS v FROM vocab),
sc AS (
  SELECT va.lang, -ln((coalesce(pc.c, 0) + {ALPHA}) / (coalesce(pv.cp, 0) + {ALPHA} * vv.v)) AS nll
  FROM va LEFT JOIN pc USING (lang, prev, nxt) LEFT JOIN pv USING (lang, prev), vv
)
SELECT lang, count(*) AS n_pairs, round(avg(nll), 6) AS cross_entropy, round(exp(avg(nll)), 6) AS perplexity
FROM sc GROUP BY lang
"""

register("m2_val_perplexity_by_lang", sql=PERPLEXITY_SQL)(perplexity_by_lang)
