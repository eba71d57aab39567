"""Registered queries over score tables (O1, O2, J4, W6, G4, G5, J6, M3, M4,
G10, J7): the driver's ``embeddings`` vectors serve as per-sequence scores
(64 candidate tokens), ``label`` as the target token."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.operators import scores, tokenizer
from tokenloom.plans import flagship as FL
from tokenloom.plans.registry import register, table

K, TOP_P, TEMP, SEED = 40, 0.9, 0.8, 42

SC = """sc AS (SELECT vec_id AS seq_id, generate_subscripts(embedding, 1) - 1 AS token, CAST(unnest(embedding) AS DOUBLE) AS logit FROM embeddings)"""
LP = f"""{SC},
ls AS (SELECT seq_id, token, logit, max(logit) OVER (PARTITION BY seq_id) AS m FROM sc),
lp AS (SELECT seq_id, token, logit, logit - (m + ln(sum(exp(logit - m)) OVER (PARTITION BY seq_id))) AS logprob FROM ls)"""


def _scores(spark, sf):
    return scores.vectors_to_scores(table(spark, sf, "embeddings"), "vec_id", "embedding")


def _labels(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("seq_id"), "label")


@register("g4_log_softmax", sql=f"WITH {LP} SELECT seq_id, CAST(token AS INTEGER) AS token, round(logprob, 9) AS logprob FROM lp")
def g4_log_softmax(spark, sf):
    d = scores.log_softmax(_scores(spark, sf), "seq_id", "logit")
    return d.select("seq_id", "token", F.round("logprob", 9).alias("logprob"))


@register("o1_topk_per_group", sql=f"""WITH {SC}
SELECT seq_id, CAST(token AS INTEGER) AS token, CAST(rank AS INTEGER) AS rank FROM (
  SELECT seq_id, token, row_number() OVER (PARTITION BY seq_id ORDER BY logit DESC, token) AS rank FROM sc) WHERE rank <= 10""")
def o1_topk_per_group(spark, sf):
    d = scores.topk_per_group(_scores(spark, sf), "seq_id", [F.col("logit").desc()], 10)
    return d.select("seq_id", "token", "rank")


SORT_SQL = f"""WITH {LP}
SELECT seq_id, CAST(token AS INTEGER) AS token, CAST(row_number() OVER (PARTITION BY seq_id ORDER BY exp(logprob) DESC, token) - 1 AS INTEGER) AS sort_pos FROM lp"""


@register("o2_sort_desc", sql=SORT_SQL)
def o2_sort_desc(spark, sf):
    d = scores.softmax(_scores(spark, sf), "seq_id", "logit", "prob")
    return scores.sort_desc(d, "seq_id", "prob", "token").select("seq_id", "token", "sort_pos")


register("j4_gather_by_rank", sql=SORT_SQL)(o2_sort_desc)


@register("w6_cumulative_prob", sql=f"""WITH {LP}
SELECT seq_id, CAST(token AS INTEGER) AS token,
       round(sum(exp(logprob)) OVER (PARTITION BY seq_id ORDER BY exp(logprob) DESC, token ROWS UNBOUNDED PRECEDING), 9) AS cum_prob FROM lp""")
def w6_cumulative_prob(spark, sf):
    d = scores.softmax(_scores(spark, sf), "seq_id", "logit", "prob")
    d = scores.cumulative_prob(d, "seq_id", "prob")
    return d.select("seq_id", "token", F.round("cum_prob", 9).alias("cum_prob"))


@register("j6_target_score", sql=f"""WITH {SC}
SELECT sc.seq_id, CAST(sc.token AS INTEGER) AS token, sc.logit FROM sc JOIN embeddings e ON e.vec_id = sc.seq_id AND e.label = sc.token""")
def j6_target_score(spark, sf):
    return scores.target_score(_scores(spark, sf), _labels(spark, sf)).select("seq_id", "token", "logit")


@register("g5_cross_entropy", sql=f"""WITH {LP},
t AS (SELECT -lp.logprob AS nll FROM lp JOIN embeddings e ON e.vec_id = lp.seq_id AND e.label = lp.token)
SELECT count(*) AS n, round(avg(nll), 6) AS cross_entropy, round(exp(avg(nll)), 6) AS perplexity FROM t""")
def g5_cross_entropy(spark, sf):
    return scores.cross_entropy(_scores(spark, sf), _labels(spark, sf))


NUC_SQL = f"""WITH {SC},
s1 AS (SELECT seq_id, token, logit / {TEMP} AS s FROM sc),
tk AS (SELECT * FROM (SELECT seq_id, token, s, row_number() OVER (PARTITION BY seq_id ORDER BY s DESC, token) AS rank FROM s1) WHERE rank <= {K}),
sm AS (SELECT seq_id, token, s, rank, max(s) OVER (PARTITION BY seq_id) AS m FROM tk),
pr AS (SELECT seq_id, token, rank, exp(s - m - ln(sum(exp(s - m)) OVER (PARTITION BY seq_id))) AS prob FROM sm),
cp AS (SELECT seq_id, token, rank, prob, sum(prob) OVER (PARTITION BY seq_id ORDER BY rank ROWS UNBOUNDED PRECEDING) AS cum_prob FROM pr),
kp AS (SELECT * FROM cp WHERE cum_prob <= {TOP_P} OR rank = 1),
nq AS (SELECT seq_id, token, rank, prob, prob / (sum(prob) OVER (PARTITION BY seq_id) + 1e-10) AS q FROM kp)"""


@register("m3_nucleus", sql=f"{NUC_SQL} SELECT seq_id, CAST(token AS INTEGER) AS token, CAST(rank AS INTEGER) AS rank, round(prob, 9) AS prob, round(q, 9) AS q FROM nq")
def m3_nucleus(spark, sf):
    d = scores.nucleus(_scores(spark, sf), K, TOP_P, TEMP)
    return d.select("seq_id", "token", "rank", F.round("prob", 9).alias("prob"), F.round("q", 9).alias("q"))


@register("m4_sample_token", sql=f"""{NUC_SQL},
cq AS (SELECT seq_id, token, rank, sum(q) OVER (PARTITION BY seq_id ORDER BY rank ROWS UNBOUNDED PRECEDING) AS c,
              {FL.S.khash(SEED, 'draw', 'seq_id')} / 4294967296.0 AS u FROM nq),
pick AS (SELECT seq_id, coalesce(min(CASE WHEN c > u THEN rank END), max(rank)) AS r FROM cq GROUP BY seq_id)
SELECT cq.seq_id, CAST(cq.token AS INTEGER) AS token FROM cq JOIN pick ON pick.seq_id = cq.seq_id AND pick.r = cq.rank""")
def m4_sample_token(spark, sf):
    kept = scores.nucleus(_scores(spark, sf), K, TOP_P, TEMP)
    return scores.sample_token(kept, SEED, "seq_id")


@register("g10_standardize_vectors", sql="""
WITH x AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS e FROM embeddings),
m AS (SELECT vec_id, e, list_sum(e) / len(e) AS mu FROM x),
v AS (SELECT vec_id, e, mu, list_sum(list_transform(e, lambda y: (y - mu) * (y - mu))) / len(e) AS var FROM m)
SELECT vec_id, round((e[1] - mu) / sqrt(var + 1e-5), 6) AS z1, round((e[2] - mu) / sqrt(var + 1e-5), 6) AS z2,
       round((e[64] - mu) / sqrt(var + 1e-5), 6) AS z64 FROM v""")
def g10_standardize_vectors(spark, sf):
    d = scores.standardize_vectors(table(spark, sf, "embeddings"), "embedding", 1e-5)
    return d.select("vec_id", F.round(F.element_at("normed", 1), 6).alias("z1"), F.round(F.element_at("normed", 2), 6).alias("z2"),
                    F.round(F.element_at("normed", 64), 6).alias("z64"))


LOOKUP_SQL = f"""WITH {FL.PREPARED_SQL}, {FL.VOCAB_SQL},
dw AS (SELECT doc_id, unnest({FL.S.words('text')}) AS token, generate_subscripts({FL.S.words('text')}, 1) AS wpos FROM documents),
di AS (SELECT dw.doc_id, v.id, row_number() OVER (PARTITION BY dw.doc_id ORDER BY dw.wpos) - 1 AS pos FROM dw JOIN vocab v USING (token))
SELECT di.doc_id, CAST(di.pos AS INTEGER) AS pos, di.id AS token, round(CAST(e.embedding[1] AS DOUBLE), 6) AS e1
FROM di LEFT JOIN embeddings e ON e.vec_id = di.id"""


@register("j7_lookup_vectors", sql=LOOKUP_SQL)
def j7_lookup_vectors(spark, sf):
    """Every token of every document; those without a vector stay, with null."""
    _, v = FL.encoded_docs(spark, sf)
    texts = table(spark, sf, "documents").select("doc_id", "text")
    toks = tokenizer.encode(texts, v, "doc_id", "text", carry=[]).select("doc_id", F.posexplode("ids").alias("pos", "token"))
    vec = table(spark, sf, "embeddings").select("vec_id", F.round(F.element_at("embedding", 1).cast("double"), 6).alias("e1"))
    return scores.lookup_vectors(toks, vec, "token", "vec_id").select("doc_id", "pos", "token", "e1")


register("j7_lookup_vectors_documents", sql=LOOKUP_SQL)(j7_lookup_vectors)
