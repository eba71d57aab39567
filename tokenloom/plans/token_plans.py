"""Registered queries: tokenizer jobs (T2-T12, J1, J5), packing (P1-P4,
P11, W5, W7), stream splits and window sampling (K1, K2, K5, K6, J2), the
count model (M1, M6, G3, G8) over the prepared corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.functions import arrays as A
from tokenloom.functions import text as T
from tokenloom.operators import ngram, pack, splits, token_job, tokenizer
from tokenloom.operators.positions import stage_rows
from tokenloom.plans import flagship as FL
from tokenloom.plans import sqlparts as S
from tokenloom.plans.registry import register, table
from tokenloom.plans.text_plans import CHUNK_SQL, chunks
from tokenloom.session import cut_lineage

B, ST = FL.BLOCK, FL.STREAMS
BASE = f"WITH {FL.PREPARED_SQL}, {FL.VOCAB_SQL}, {FL.STREAM_SQL}"


def _enc(spark, sf):
    return FL.encoded_docs(spark, sf)


def _vocab_sql_full():
    return "(SELECT '<|endoftext|>' AS token, 0 AS id, true AS special UNION ALL SELECT '<pad>', 1, true UNION ALL SELECT token, id, false FROM vocab)"


# --- T: tokenizer -------------------------------------------------------------

@register("t2_build_vocab", sql=f"{BASE} SELECT token, id, special FROM {_vocab_sql_full()}")
def t2_build_vocab(spark, sf):
    return FL.vocab(spark, sf)


@register("t3_add_special_token", sql=f"""{BASE}
SELECT token, id, special FROM {_vocab_sql_full()}
UNION ALL SELECT '<mask>', (SELECT CAST(max(id) + 1 AS INTEGER) FROM {_vocab_sql_full()}), true""")
def t3_add_special_token(spark, sf):
    v = cut_lineage(FL.vocab(spark, sf))
    v = tokenizer.add_special_token(v, tokenizer.END_TOKEN)  # present: unchanged
    return tokenizer.add_special_token(v, "<mask>")  # absent: appended


@register("t6_token_lookup", sql=f"{BASE} SELECT 0 AS end_id, 1 AS pad_id, count(*) + 2 AS vocab_size FROM vocab")
def t6_token_lookup(spark, sf):
    from tokenloom.operators.positions import attach_scalars

    v = cut_lineage(FL.vocab(spark, sf))
    e = tokenizer.token_id(v, tokenizer.END_TOKEN).withColumnRenamed("id", "end_id")
    p = tokenizer.token_id(v, tokenizer.PAD_TOKEN).withColumnRenamed("id", "pad_id")
    return attach_scalars(attach_scalars(e, p), tokenizer.vocab_size(v))


ENC_SQL = f"""{BASE},
ids AS (
  SELECT a.doc_id, a.lang, count(e.id) AS n_ids,
         coalesce(array_to_string(list(e.id ORDER BY e.wpos) FILTER (WHERE e.id IS NOT NULL), ','), '') AS ids_s
  FROM aug a LEFT JOIN enc e USING (doc_id) GROUP BY a.doc_id, a.lang
)"""


@register("t4_encode", sql=f"{ENC_SQL} SELECT doc_id, lang, CAST(n_ids AS INTEGER) AS n_ids, md5(ids_s) AS ids_md5 FROM ids")
def t4_encode(spark, sf):
    enc, _ = _enc(spark, sf)
    return enc.select("doc_id", "lang", F.size("ids").alias("n_ids"), A.ints_md5("ids").alias("ids_md5"))


register("j1_lookup_ids", sql=f"{ENC_SQL} SELECT doc_id, lang, CAST(n_ids AS INTEGER) AS n_ids, md5(ids_s) AS ids_md5 FROM ids")(t4_encode)


@register("t5_decode", sql=f"""{BASE}
SELECT a.doc_id, md5(coalesce(string_agg(w.token, ' ' ORDER BY w.wpos) FILTER (WHERE v.id IS NOT NULL), '')) AS text_md5
FROM aug a LEFT JOIN w USING (doc_id) LEFT JOIN vocab v ON v.token = w.token GROUP BY a.doc_id""")
def t5_decode(spark, sf):
    enc, v = _enc(spark, sf)
    d = tokenizer.decode(enc, v, "doc_id", "ids", "text")
    return d.select("doc_id", F.md5("text").alias("text_md5"))


@register("j5_drop_special", sql=f"{ENC_SQL} SELECT doc_id, md5(ids_s) AS ids_md5 FROM ids")
def j5_drop_special(spark, sf):
    enc, v = _enc(spark, sf)
    withspec = enc.withColumn("ids", F.concat(F.array(F.lit(0)), "ids", F.array(F.lit(1), F.lit(0))))
    return tokenizer.drop_special(withspec, v, "ids").select("doc_id", A.ints_md5("ids").alias("ids_md5"))


@register("j5_drop_special_words", sql=f"""{BASE},
sw AS (SELECT doc_id, unnest({S.words("replace(text, '. ', ' . <|endoftext|> ')")}) AS token, generate_subscripts({S.words("replace(text, '. ', ' . <|endoftext|> ')")}, 1) AS k FROM aug),
si AS (SELECT a.doc_id, count(*) FILTER (WHERE sw.token IN ('<|endoftext|>', '<pad>')) AS n_dropped,
              coalesce(array_to_string(list(v.id ORDER BY sw.k) FILTER (WHERE v.id IS NOT NULL), ','), '') AS ids_s
       FROM aug a LEFT JOIN sw USING (doc_id) LEFT JOIN vocab v ON v.token = sw.token GROUP BY a.doc_id)
SELECT doc_id, CAST(n_dropped AS INTEGER) AS n_dropped, md5(ids_s) AS ids_md5 FROM si""")
def j5_drop_special_words(spark, sf):
    """J5 on texts that spell the end token between sentences: encoding gives
    its id, and dropping must take exactly those."""
    p = FL.prepared_docs(spark, sf, materialize=True)
    v = cut_lineage(FL.vocab(spark, sf, p))
    marked = p.select("doc_id", F.replace("text", F.lit(". "), F.lit(f" . {tokenizer.END_TOKEN} ")).alias("text"))
    enc = tokenizer.encode(marked, v, "doc_id", "text", carry=[]).withColumn("_n", F.size("ids"))
    d = tokenizer.drop_special(enc, v, "ids")
    return d.select("doc_id", (F.col("_n") - F.size("ids")).alias("n_dropped"), A.ints_md5("ids").alias("ids_md5"))


@register("x18_last_tokens", sql=f"""{BASE},
p AS (SELECT a.doc_id, coalesce(list(e.id ORDER BY e.wpos) FILTER (WHERE e.id IS NOT NULL), CAST([] AS INTEGER[])) AS l FROM aug a LEFT JOIN enc e USING (doc_id) GROUP BY a.doc_id)
SELECT doc_id, CAST(least(len(l), {B}) AS INTEGER) AS n, md5(array_to_string(l[greatest(len(l) - {B}, 0) + 1:], ',')) AS tail_md5 FROM p""")
def x18_last_tokens(spark, sf):
    """The last B ids of each document (all, where it has fewer)."""
    enc, _ = _enc(spark, sf)
    d = enc.select("doc_id", A.last_n("ids", B).alias("tail"))
    return d.select("doc_id", F.size("tail").alias("n"), A.ints_md5("tail").alias("tail_md5"))


@register("t7_count_tokens", sql=f"{BASE} SELECT CAST(sum(n) AS BIGINT) AS n_tokens, CAST(sum(n) - sum(n) % {B} AS BIGINT) AS n_aligned FROM doc_n")
def t7_count_tokens(spark, sf):
    enc, _ = _enc(spark, sf)
    return tokenizer.count_tokens(enc, "ids", B)


@register("t11_attention_mask", sql=f"{ENC_SQL} SELECT doc_id, CAST(n_ids AS BIGINT) AS mask_sum, CAST(n_ids AS INTEGER) AS mask_len FROM ids")
def t11_attention_mask(spark, sf):
    enc, _ = _enc(spark, sf)
    d = tokenizer.attention_mask(enc, "ids")
    return d.select("doc_id", F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("mask_sum"),
                    F.size("attention_mask").alias("mask_len"))


@register("t12_token_preview", sql=f"""{BASE},
p AS (SELECT a.doc_id, list(e.id ORDER BY e.wpos) FILTER (WHERE e.id IS NOT NULL) AS l FROM aug a LEFT JOIN enc e USING (doc_id) GROUP BY a.doc_id)
SELECT doc_id, coalesce(array_to_string(l[1:20], ','), '') AS preview FROM p""")
def t12_token_preview(spark, sf):
    enc, _ = _enc(spark, sf)
    return tokenizer.token_preview(enc, "ids", 20).select("doc_id", A.ints_str("preview").alias("preview"))


@register("t10_pad_batch", sql=f"""{ENC_SQL},
pb AS (SELECT doc_id, n_ids, ids_s, max(n_ids) OVER (PARTITION BY doc_id // 16) AS longest FROM ids)
SELECT doc_id, CAST(longest AS INTEGER) AS width,
       md5(concat_ws(',', CASE WHEN ids_s = '' THEN NULL ELSE ids_s END,
                     CASE WHEN longest > n_ids THEN array_to_string(list_transform(range(longest - n_ids), lambda i: 1), ',') END)) AS ids_md5,
       CAST(n_ids AS BIGINT) AS mask_sum
FROM pb""")
def t10_pad_batch(spark, sf):
    enc, _ = _enc(spark, sf)
    d = enc.withColumn("batch", (F.col("doc_id") / 16).cast("long"))
    d = tokenizer.pad_batch(d, "batch", "ids", pad_id=1)
    return d.select("doc_id", F.size("ids").alias("width"), A.ints_md5("ids").alias("ids_md5"),
                    F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("mask_sum"))


SAMPLE_CHARS = 1_000_000


@register("t8_estimate_tokens", sql=f"""{CHUNK_SQL}, {FL.VOCAB_SQL},
co AS (SELECT chunk_id, text, sum(length(text)) OVER (ORDER BY chunk_id ROWS UNBOUNDED PRECEDING) - length(text) AS off FROM chunks),
pa AS (SELECT chunk_id, text, substring(text, 1, CAST(greatest(0, least(length(text), {SAMPLE_CHARS} - off)) AS BIGINT)) AS part FROM co),
pw AS (SELECT unnest({S.words('part')}) AS token FROM pa),
st AS (SELECT count(*) AS sample_tokens FROM pw JOIN vocab USING (token)),
sz AS (SELECT sum(strlen(text)) AS total_bytes, sum(strlen(part)) AS sample_bytes FROM pa),
r AS (SELECT CAST(total_bytes AS BIGINT) AS total_bytes, CAST(sample_bytes AS BIGINT) AS sample_bytes, sample_tokens,
             CASE WHEN sample_bytes > 0 THEN CAST(floor(sample_tokens * (total_bytes / sample_bytes)) AS BIGINT) ELSE 0 END AS estimated
      FROM sz, st)
SELECT total_bytes, sample_bytes, sample_tokens, estimated, estimated - estimated % {B} AS estimated_aligned FROM r""")
def t8_estimate_tokens(spark, sf):
    v = cut_lineage(FL.vocab(spark, sf))
    c = stage_rows(chunks(spark, sf), "chunks")
    return tokenizer.estimate_tokens(c, v, "chunk_id", "text", SAMPLE_CHARS, B)


N_LINES = 500
LINES_SQL = f"""
dl AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
dx AS (SELECT doc_id, unnest(ls) AS raw, generate_subscripts(ls, 1) AS k FROM dl),
ln AS (SELECT row_number() OVER (ORDER BY doc_id, k) - 1 AS line_no, {S.strip('raw')} AS line FROM dx),
lb AS (SELECT line_no, line, CASE WHEN length(line) > 0 AND (line_no + 1) % {N_LINES} = 0 THEN 1 ELSE 0 END AS b FROM ln),
lg AS (SELECT line_no, line, sum(b) OVER (ORDER BY line_no ROWS UNBOUNDED PRECEDING) - b AS group_id FROM lb),
grp AS (SELECT group_id, string_agg(line, ' ' ORDER BY line_no) AS text FROM lg WHERE length(line) > 0 GROUP BY group_id)"""


@register("t9_encode_line_chunks", sql=f"""WITH {FL.PREPARED_SQL}, {FL.VOCAB_SQL}, {LINES_SQL},
gw AS (SELECT group_id, unnest({S.words('text')}) AS token, generate_subscripts({S.words('text')}, 1) AS wpos FROM grp),
gi AS (SELECT g.group_id, list(v.id ORDER BY gw.wpos) FILTER (WHERE v.id IS NOT NULL) AS l
       FROM grp g LEFT JOIN gw USING (group_id) LEFT JOIN vocab v ON v.token = gw.token GROUP BY g.group_id),
ga AS (SELECT group_id, coalesce(l, []) AS l FROM gi)
SELECT group_id, CAST(len(l) AS INTEGER) AS n_tokens, CAST(len(l) - len(l) % {B} AS INTEGER) AS n_kept,
       md5(array_to_string(l[1:len(l) - len(l) % {B}], ',')) AS ids_md5
FROM ga""")
def t9_encode_line_chunks(spark, sf):
    v = cut_lineage(FL.vocab(spark, sf))
    docs = table(spark, sf, "documents").select("doc_id", "text")
    groups = tokenizer.doc_line_groups(docs, "doc_id", "text", N_LINES, key_source=table(spark, sf, "documents").select("doc_id"))
    enc = tokenizer.encode(groups, v, "group_id", "text", carry=[])
    n = F.size("ids")
    enc = enc.withColumn("n_tokens", n)
    al = pack.align_each(enc, "ids", B)
    return al.select("group_id", "n_tokens", F.size("ids").alias("n_kept"), A.ints_md5("ids").alias("ids_md5"))


MEMMAP_LINES = LINES_SQL.replace("FROM documents", "FROM aug")

register("t9_tokenize_to_memmap", sql=f"""WITH {FL.PREPARED_SQL}, {FL.VOCAB_SQL}, {MEMMAP_LINES},
fl AS (SELECT doc_id, text || chr(10) AS text FROM aug),
co AS (SELECT doc_id, text, sum(length(text)) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - length(text) AS off FROM fl),
pa AS (SELECT text, substring(text, 1, CAST(greatest(0, least(length(text), {SAMPLE_CHARS} - off)) AS BIGINT)) AS part FROM co),
pw AS (SELECT unnest({S.words('part')}) AS token FROM pa),
st AS (SELECT count(*) AS n FROM pw JOIN vocab USING (token)),
sz AS (SELECT sum(strlen(text)) AS total, sum(strlen(part)) AS sampled FROM pa),
es AS (SELECT CASE WHEN sampled > 0 THEN CAST(floor(n * (total / sampled)) AS BIGINT) ELSE 0 END AS e FROM sz, st),
cp AS (SELECT e - e % {B} AS cap FROM es),
gw AS (SELECT group_id, unnest({S.words('text')}) AS token, generate_subscripts({S.words('text')}, 1) AS wpos FROM grp),
gi AS (SELECT gw.group_id, v.id, row_number() OVER (PARTITION BY gw.group_id ORDER BY gw.wpos) - 1 AS k,
              count(*) OVER (PARTITION BY gw.group_id) AS n FROM gw JOIN vocab v USING (token)),
gt AS (SELECT group_id, max(n) - max(n) % {B} AS m FROM gi GROUP BY group_id),
go AS (SELECT group_id, m, sum(m) OVER (ORDER BY group_id ROWS UNBOUNDED PRECEDING) - m AS s FROM gt),
tk AS (SELECT gi.id, go.s + gi.k AS pos FROM gi JOIN go USING (group_id) WHERE gi.k < go.m)
SELECT CAST(pos // {B} AS BIGINT) AS block_id, md5(array_to_string(list(id ORDER BY pos), ',')) AS tokens_md5
FROM tk, cp WHERE pos < cap GROUP BY pos // {B}""")(lambda spark, sf: _memmap(spark, sf))


def _memmap(spark, sf):
    """The trainer's whole tokenizing job on the prepared corpus."""
    p = FL.prepared_docs(spark, sf, materialize=True)
    v = cut_lineage(FL.vocab(spark, sf, p))
    blocks = token_job.tokenize_to_blocks(p, v, "doc_id", "text", N_LINES, SAMPLE_CHARS, B, key_source=table(spark, sf, "documents").select("doc_id"))
    return blocks.select("block_id", A.ints_md5("tokens").alias("tokens_md5"))


# --- P: packing ---------------------------------------------------------------

@register("p1_global_offsets", sql=f"{BASE} SELECT doc_id, lang, CAST(s AS BIGINT) AS \"offset\", CAST(n AS BIGINT) AS n_tokens FROM off")
def p1_global_offsets(spark, sf):
    enc, _ = _enc(spark, sf)
    d = pack.global_offsets(enc, "ids", ["doc_id"], ST, key_source=table(spark, sf, "documents").select("doc_id"))
    return d.select("doc_id", "lang", "offset", "n_tokens")


register("w7_running_offset", sql=f"{BASE} SELECT doc_id, lang, CAST(s AS BIGINT) AS \"offset\", CAST(n AS BIGINT) AS n_tokens FROM off")(p1_global_offsets)

BLOCKS_SQL = f"{BASE} SELECT lang, pos // {B} AS block_id, md5(array_to_string(list(id ORDER BY pos), ',')) AS tokens_md5 FROM kt GROUP BY lang, pos // {B}"


@register("p2_pack_blocks", sql=BLOCKS_SQL)
def p2_pack_blocks(spark, sf):
    blocks, _ = FL.lm_blocks(spark, sf, lookahead=0)
    return blocks.select("lang", "block_id", A.ints_md5("tokens").alias("tokens_md5"))


register("s8_block_table", sql=BLOCKS_SQL)(p2_pack_blocks)


@register("p3_pack_per_chunk", sql=f"""{BASE},
n2 AS (SELECT doc_id, lang, n - n % {B} AS m FROM doc_n),
o2 AS (SELECT doc_id, lang, m, sum(m) OVER (PARTITION BY lang ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - m AS s2 FROM n2),
t2 AS (SELECT e.lang, e.id, o2.s2 + row_number() OVER (PARTITION BY e.doc_id ORDER BY e.wpos) - 1 AS pos,
              row_number() OVER (PARTITION BY e.doc_id ORDER BY e.wpos) - 1 AS k, o2.m
       FROM enc e JOIN o2 USING (doc_id))
SELECT lang, pos // {B} AS block_id, md5(array_to_string(list(id ORDER BY pos), ',')) AS tokens_md5 FROM t2 WHERE k < m GROUP BY lang, pos // {B}""")
def p3_pack_per_chunk(spark, sf):
    enc, _ = _enc(spark, sf)
    blocks = pack.pack_blocks(enc, "ids", ["doc_id"], ST, B, policy="per_chunk", key_source=table(spark, sf, "documents").select("doc_id"))
    return blocks.select("lang", "block_id", A.ints_md5("tokens").alias("tokens_md5"))


CAP = 20_000


@register("p4_cap_stream", sql=f"{BASE} SELECT lang, pos // {B} AS block_id, md5(array_to_string(list(id ORDER BY pos), ',')) AS tokens_md5 FROM kt WHERE pos < {CAP} GROUP BY lang, pos // {B}")
def p4_cap_stream(spark, sf):
    enc, _ = _enc(spark, sf)
    blocks = pack.pack_blocks(enc, "ids", ["doc_id"], ST, B, cap=CAP, key_source=table(spark, sf, "documents").select("doc_id"))
    return blocks.select("lang", "block_id", A.ints_md5("tokens").alias("tokens_md5"))


XY_SQL = f"""{BASE},
win AS (SELECT k1.lang, k1.pos // {B} AS block_id, list(k1.id ORDER BY k1.pos) AS l FROM kt k1 GROUP BY k1.lang, k1.pos // {B}),
nx AS (SELECT lang, pos // {B} - 1 AS block_id, id FROM kt WHERE pos % {B} = 0 AND pos > 0),
xl AS (SELECT w.lang, w.block_id, CASE WHEN nx.id IS NULL THEN w.l ELSE list_append(w.l, nx.id) END AS l
       FROM win w LEFT JOIN nx USING (lang, block_id))
SELECT lang, block_id, md5(array_to_string(l[1:{B}], ',')) AS x_md5, md5(array_to_string(l[2:{B + 1}], ',')) AS y_md5 FROM xl"""


@register("p11_shift_xy", sql=XY_SQL)
def p11_shift_xy(spark, sf):
    blocks, _ = FL.lm_blocks(spark, sf, lookahead=1)
    d = pack.shift_xy(blocks, B, "tokens")
    return d.select("lang", "block_id", A.ints_md5("x").alias("x_md5"), A.ints_md5("y").alias("y_md5"))


PAIRS_SQL = f"{BASE}, pr AS (SELECT lang, pos, id AS prev, lead(id) OVER (PARTITION BY lang ORDER BY pos) AS nxt FROM kt)"


@register("w5_next_token", sql=f"{PAIRS_SQL} SELECT lang, pos, prev AS token, nxt AS next_token FROM pr WHERE nxt IS NOT NULL")
def w5_next_token(spark, sf):
    """Label of every position = the next token of the kept stream
    (array pairs over lookahead blocks; no per-stream window)."""
    blocks, _ = FL.lm_blocks(spark, sf, lookahead=1)
    p = ngram.block_pairs(blocks, B, ST)
    return p.select("lang", "pos", F.col("prev").alias("token"), F.col("next").alias("next_token"))


# --- K: splits and sampling -------------------------------------------------------

@register("k1_split_tail", sql=f"""{BASE}
SELECT lang, 'train' AS split, CAST(0 AS BIGINT) AS start, CAST(k - k // 5 AS BIGINT) AS "end" FROM kept
UNION ALL SELECT lang, 'val', CAST(k - k // 5 AS BIGINT), CAST(k AS BIGINT) FROM kept""")
def k1_split_tail(spark, sf):
    return splits.split_tail(splits.kept_lengths(_enc(spark, sf)[0], "ids", ST, B), 5, ST)


@register("k2_split_ratio", sql=f"""{BASE}
SELECT lang, 'train' AS split, CAST(0 AS BIGINT) AS start, CAST(k - floor(k * {FL.VAL_RATIO}) AS BIGINT) AS "end" FROM kept
UNION ALL SELECT lang, 'val', CAST(k - floor(k * {FL.VAL_RATIO}) AS BIGINT), CAST(k AS BIGINT) FROM kept""")
def k2_split_ratio(spark, sf):
    return splits.split_ratio(splits.kept_lengths(_enc(spark, sf)[0], "ids", ST, B), FL.VAL_RATIO, ST)


@register("k9_require_span", sql=f"""{BASE}
SELECT lang, 'train' AS split, k - CAST(floor(k * {FL.VAL_RATIO}) AS BIGINT) - {B + 1} AS span,
       k - CAST(floor(k * {FL.VAL_RATIO}) AS BIGINT) - {B + 1} > 0 AS ok FROM kept
UNION ALL SELECT lang, 'val', CAST(floor(k * {FL.VAL_RATIO}) AS BIGINT) - {B + 1}, CAST(floor(k * {FL.VAL_RATIO}) AS BIGINT) - {B + 1} > 0 FROM kept""")
def k9_require_span(spark, sf):
    """K9: the window-start bound of every split and whether the guard passes
    (the query reports instead of failing on small data)."""
    b = splits.split_ratio(splits.kept_lengths(_enc(spark, sf)[0], "ids", ST, B), FL.VAL_RATIO, ST)
    return splits.require_span(b, B, strict=False).select("lang", "split", "span", "ok")


STEPS, MICRO, BATCH = 4, 4, 8


def _window_sql(split: str, steps: int, micro: int, batch: int) -> str:
    lo = "0" if split == "train" else f"k - CAST(floor(k * {FL.VAL_RATIO}) AS BIGINT)"
    hi = f"k - CAST(floor(k * {FL.VAL_RATIO}) AS BIGINT)" if split == "train" else "k"
    return f"""{BASE},
bd AS (SELECT lang, {lo} AS start, {hi} - ({lo}) - {B + 1} AS span FROM kept),
dr AS (SELECT i // {micro * batch} AS step, (i // {batch}) % {micro} AS micro, i % {batch} AS slot FROM range({steps * micro * batch}) t(i)),
ds AS (SELECT bd.lang, dr.step, dr.micro, dr.slot,
              bd.start + {S.khash(FL.SEED, 'window', f"'{split}'", 'bd.lang', 'dr.step', 'dr.micro', 'dr.slot')} % bd.span AS pos
       FROM dr, bd WHERE bd.span > 0),
wt AS (SELECT ds.lang, ds.step, ds.micro, ds.slot, ds.pos, list(kt.id ORDER BY kt.pos) AS l
       FROM ds JOIN kt ON kt.lang = ds.lang AND kt.pos >= ds.pos AND kt.pos <= ds.pos + {B}
       GROUP BY ds.lang, ds.step, ds.micro, ds.slot, ds.pos)"""


def _windows(spark, sf, split, steps, micro, batch, staged=None):
    blocks, v = staged if staged is not None else FL.lm_blocks(spark, sf, lookahead=0)
    bounds = splits.split_ratio(splits.stream_lengths(blocks, ST, B), FL.VAL_RATIO, ST)
    starts = splits.draw_starts(spark, bounds, split, steps, micro, batch, B, FL.SEED, streams=ST)
    w = splits.gather_windows(starts, blocks, B, "tokens", streams=ST)
    return pack.shift_xy(w, B, "tokens"), blocks, bounds, v


WIN_OUT = f"SELECT lang, step, micro, slot, pos, md5(array_to_string(l[1:{B}], ',')) AS x_md5, md5(array_to_string(l[2:{B + 1}], ',')) AS y_md5 FROM wt"


@register("k5_sample_windows", sql=_window_sql("train", STEPS, MICRO, BATCH) + " " + WIN_OUT)
def k5_sample_windows(spark, sf):
    w, *_ = _windows(spark, sf, "train", STEPS, MICRO, BATCH)
    return w.select("lang", "step", "micro", "slot", "pos", A.ints_md5("x").alias("x_md5"), A.ints_md5("y").alias("y_md5"))


register("j2_gather_windows", sql=_window_sql("train", STEPS, MICRO, BATCH) + " " + WIN_OUT)(k5_sample_windows)


@register("k6_val_windows", sql=_window_sql("val", 1, 1, 32) + " " + WIN_OUT)
def k6_val_windows(spark, sf):
    w, *_ = _windows(spark, sf, "val", 1, 1, 32)
    return w.select("lang", "step", "micro", "slot", "pos", A.ints_md5("x").alias("x_md5"), A.ints_md5("y").alias("y_md5"))


# --- M / G: count model ------------------------------------------------------------

MODEL_SQL = f"""{PAIRS_SQL},
b AS (SELECT lang, k AS n, k - CAST(floor(k * {FL.VAL_RATIO}) AS BIGINT) AS te FROM kept),
tr AS (SELECT p.lang, prev, nxt FROM pr p JOIN b USING (lang) WHERE nxt IS NOT NULL AND p.pos + 1 < b.te),
pc AS (SELECT lang, prev, nxt, count(*) AS c FROM tr GROUP BY lang, prev, nxt),
pv AS (SELECT lang, prev, sum(c) AS cp FROM pc GROUP BY lang, prev),
vv AS (SELECT count(*) + 2 AS v FROM vocab)"""


def _model(spark, sf, staged=None):
    blocks, v = staged if staged is not None else FL.lm_blocks(spark, sf, lookahead=1)
    bounds = splits.split_ratio(splits.stream_lengths(blocks, ST, B), FL.VAL_RATIO, ST)
    counts = ngram.split_pair_counts(ngram.block_pairs(blocks, B, ST), bounds, ST).filter(F.col("split") == "train")
    model = cut_lineage(ngram.fit_from_counts(counts, ST), "model")
    return model, v


@register("m1_fit_next_token", sql=f"""{MODEL_SQL}
SELECT pc.lang, pc.prev, pc.nxt AS "next", pc.c, CAST(pv.cp AS BIGINT) AS c_prev, round((pc.c + {FL.ALPHA}) / (pv.cp + {FL.ALPHA} * vv.v), 9) AS p
FROM pc JOIN pv USING (lang, prev), vv""")
def m1_fit_next_token(spark, sf):
    model, v = _model(spark, sf)
    p = ngram.next_token_probs(model, tokenizer.vocab_size(v), FL.ALPHA)
    return p.select("lang", "prev", "next", "c", F.col("c_prev").cast("long").alias("c_prev"), F.round("p", 9).alias("p"))


@register("m6_rank_docs_by_perplexity", sql=f"""{MODEL_SQL},
dp AS (SELECT e.doc_id, e.lang, e.id AS prev, lead(e.id) OVER (PARTITION BY e.doc_id ORDER BY e.wpos) AS nxt FROM enc e),
sc AS (SELECT dp.doc_id, dp.lang, -ln((coalesce(pc.c, 0) + {FL.ALPHA}) / (coalesce(pv.cp, 0) + {FL.ALPHA} * vv.v)) AS nll
       FROM dp LEFT JOIN pc USING (lang, prev, nxt) LEFT JOIN pv USING (lang, prev), vv WHERE dp.nxt IS NOT NULL)
SELECT doc_id, lang, count(*) AS n_pairs, round(avg(nll), 6) AS cross_entropy, round(exp(avg(nll)), 6) AS perplexity
FROM sc GROUP BY doc_id, lang""")
def m6_rank_docs_by_perplexity(spark, sf):
    enc, v = _enc(spark, sf)
    enc = stage_rows(enc, "encoded")  # feeds both the block table and the scoring
    model, _ = _model(spark, sf, FL.lm_blocks(spark, sf, lookahead=1, encoded=(enc, v)))
    return ngram.rank_docs_by_perplexity(enc, model, tokenizer.vocab_size(v), FL.ALPHA, "doc_id", "ids", ST)


@register("g3_token_histogram", sql=f"{BASE} SELECT token, count(*) AS count FROM w GROUP BY token")
def g3_token_histogram(spark, sf):
    return tokenizer.word_counts(FL.prepared_docs(spark, sf), "text")


@register("g3_pair_counts", sql=f"""{BASE},
wp AS (SELECT token AS a, lead(token) OVER (PARTITION BY doc_id ORDER BY wpos) AS b FROM w)
SELECT a AS left_token, b AS right_token, count(*) AS count FROM wp WHERE b IS NOT NULL GROUP BY a, b""")
def g3_pair_counts(spark, sf):
    """G3 pairs: adjacent word pairs inside documents (``zip`` of shifted slices)."""
    d = FL.prepared_docs(spark, sf).select("doc_id", T.whitespace_words("text").alias("w"))
    n = F.greatest(F.size("w") - 1, F.lit(0))
    z = d.select(F.explode(F.arrays_zip(F.slice("w", 1, n).alias("a"), F.slice("w", 2, n).alias("b"))).alias("p"))
    return z.groupBy(F.col("p.a").alias("left_token"), F.col("p.b").alias("right_token")).agg(F.count(F.lit(1)).alias("count"))


@register("g8_mean_step_loss", sql=f"""{_window_sql('train', STEPS, MICRO, BATCH)},
pr AS (SELECT kt.lang, kt.pos, kt.id AS prev, lead(kt.id) OVER (PARTITION BY kt.lang ORDER BY kt.pos) AS nxt FROM kt),
{MODEL_SQL.split(PAIRS_SQL + ',', 1)[1]},
wp AS (SELECT wt.lang, wt.step, wt.micro, wt.l[i] AS prev, wt.l[i + 1] AS nxt FROM wt, range(1, {B + 1}) r(i)),
ms AS (SELECT wp.lang, wp.step, wp.micro, avg(-ln((coalesce(pc.c, 0) + {FL.ALPHA}) / (coalesce(pv.cp, 0) + {FL.ALPHA} * vv.v))) AS loss
       FROM wp LEFT JOIN pc USING (lang, prev, nxt) LEFT JOIN pv USING (lang, prev), vv GROUP BY wp.lang, wp.step, wp.micro)
SELECT lang, step, round(avg(loss), 6) AS mean_loss FROM ms GROUP BY lang, step""")
def g8_mean_step_loss(spark, sf):
    """Count-model loss of every sampled training micro-batch (K5
    windows), averaged over the micro-batches of each step."""
    from tokenloom.operators.metrics import mean_step_loss

    staged = FL.lm_blocks(spark, sf, lookahead=1)  # one pipeline: windows read the first B tokens of each block
    w, blocks, bounds, v = _windows(spark, sf, "train", STEPS, MICRO, BATCH, staged)
    model = _model(spark, sf, staged)[0]
    pairs = w.select("lang", "step", "micro", "slot", F.explode(F.arrays_zip(F.col("x").alias("prev"), F.col("y").alias("next"))).alias("p"))
    pairs = pairs.select("lang", "step", "micro", "slot", F.col("p.prev").alias("prev"), F.col("p.next").alias("next"))
    s = ngram.score_pairs(pairs, model, tokenizer.vocab_size(v), FL.ALPHA, ST, group=["lang", "step", "micro"])
    micro_loss = s.select("lang", "step", "micro", (F.col("nll_sum") / F.col("n_pairs")).alias("loss"))
    return mean_step_loss(micro_loss, ["lang", "step"], "loss")
