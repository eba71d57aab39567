"""Registered queries: instruction-tuning rows from ``conversations``
(F5, F6, P7-P10, P12, P13, K3, K7, K8, G6, G7, G9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.functions import arrays as A
from tokenloom.operators import filters, ngram, pack, sft, splits, tokenizer
from tokenloom.plans import sqlparts as S
from tokenloom.plans.registry import register, table
from tokenloom.session import cut_lineage

B, EOS, VOCAB = 64, 0, 4096
VAL_RATIO, BATCH, STEPS = 0.1, 16, 40
KEYS = ["conv_id", "turn"]


def _triples(spark, sf):
    return sft.triples_from_conversations(table(spark, sf, "conversations"))


def conv_vocab(spark, sf):
    c = table(spark, sf, "conversations").select(F.coalesce("text", F.lit("")).alias("text"))
    return cut_lineage(tokenizer.build_vocab(c, "text", VOCAB))


def _rows(spark, sf, truncate_pad=True):
    v = conv_vocab(spark, sf)
    return cut_lineage(sft.sft_rows(_triples(spark, sf), v, KEYS, B, EOS, truncate_pad)), v


BASE = f"""WITH cv AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
tw AS (SELECT unnest({S.words('text')}) AS token FROM cv),
cnt AS (SELECT token, count(*) AS c FROM tw WHERE token NOT IN ('<|endoftext|>', '<pad>') GROUP BY token),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY c DESC, token) + 1 AS INTEGER) AS id FROM cnt
          QUALIFY row_number() OVER (ORDER BY c DESC, token) <= {VOCAB - 2}),
sysm AS (SELECT conv_id, arg_min(text, turn) AS context FROM cv WHERE role = 'system' GROUP BY conv_id),
tri AS (SELECT u.conv_id, a.turn, u.text AS instruction, coalesce(s.context, '') AS context, a.text AS response
        FROM cv u JOIN cv a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND u.role = 'user' AND a.role = 'assistant'
        LEFT JOIN sysm s ON s.conv_id = u.conv_id),
pw AS (SELECT conv_id, turn, {S.words("instruction || ' ' || context")} AS pl, {S.words('response')} AS rl FROM tri),
pu AS (SELECT conv_id, turn, unnest(pl) AS token, generate_subscripts(pl, 1) AS k FROM pw),
ru AS (SELECT conv_id, turn, unnest(rl) AS token, generate_subscripts(rl, 1) AS k FROM pw),
pi AS (SELECT t.conv_id, t.turn, coalesce(list(v.id ORDER BY pu.k) FILTER (WHERE v.id IS NOT NULL), CAST([] AS INTEGER[])) AS p
       FROM tri t LEFT JOIN pu USING (conv_id, turn) LEFT JOIN vocab v ON v.token = pu.token GROUP BY t.conv_id, t.turn),
ri AS (SELECT t.conv_id, t.turn, list_append(coalesce(list(v.id ORDER BY ru.k) FILTER (WHERE v.id IS NOT NULL), CAST([] AS INTEGER[])), {EOS}) AS r
       FROM tri t LEFT JOIN ru USING (conv_id, turn) LEFT JOIN vocab v ON v.token = ru.token GROUP BY t.conv_id, t.turn),
ex AS (SELECT conv_id, turn, len(p) AS n_prompt, len(r) AS n_response, list_concat(p, r) AS ids,
              list_concat(list_transform(p, lambda x: -100), r) AS labels FROM pi JOIN ri USING (conv_id, turn)),
tp AS (SELECT conv_id, turn, n_prompt, n_response,
              list_concat(ids[1:{B}], list_transform(range(greatest(0, {B} - len(ids))), lambda i: {EOS})) AS input_ids,
              list_concat(labels[1:{B}], list_transform(range(greatest(0, {B} - len(labels))), lambda i: -100)) AS labels FROM ex)"""


@register("f6_default_field", sql=f"{BASE} SELECT conv_id, turn, md5(instruction) AS instruction_md5, md5(context) AS context_md5, md5(response) AS response_md5 FROM tri")
def f6_default_field(spark, sf):
    t = filters.default_field(_triples(spark, sf), "context", "")
    return t.select(*KEYS, F.md5("instruction").alias("instruction_md5"), F.md5("context").alias("context_md5"),
                    F.md5("response").alias("response_md5"))


@register("f6_absent_field", sql="""
SELECT conv_id, turn, md5(coalesce(CASE WHEN role = 'assistant' THEN text END, '')) AS text_md5, '' AS context FROM conversations""")
def f6_absent_field(spark, sf):
    """F6 with a column that is not there, and one with nulls (texts of other roles)."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.when(F.col("role") == "assistant", F.col("text")).alias("text"))
    d = filters.default_field(filters.default_field(c, "text"), "context")
    return d.select("conv_id", "turn", F.md5("text").alias("text_md5"), "context")


@register("f5_has_script", sql=f"{BASE} SELECT conv_id, turn FROM tri WHERE {S.has_script('instruction || context || response')}")
def f5_has_script(spark, sf):
    """F5 with the kana/CJK class on instruction triples (the SFT filter)."""
    return filters.has_script(_triples(spark, sf), ["instruction", "context", "response"]).select(*KEYS)


@register("p7_sft_example", sql=f"""{BASE}
SELECT conv_id, turn, CAST(n_prompt AS INTEGER) AS n_prompt, md5(array_to_string(ids, ',')) AS ids_md5, md5(array_to_string(labels, ',')) AS labels_md5 FROM ex""")
def p7_sft_example(spark, sf):
    rows, _ = _rows(spark, sf, truncate_pad=False)
    return rows.select(*KEYS, F.size("prompt_ids").alias("n_prompt"), A.ints_md5("input_ids").alias("ids_md5"), A.ints_md5("labels").alias("labels_md5"))


@register("p8_truncate", sql=f"""{BASE}
SELECT conv_id, turn, md5(array_to_string(ids[1:{B}], ',')) AS ids_md5, md5(array_to_string(labels[1:{B}], ',')) AS labels_md5 FROM ex""")
def p8_truncate(spark, sf):
    rows, _ = _rows(spark, sf, truncate_pad=False)
    d = pack.truncate(rows, B)
    return d.select(*KEYS, A.ints_md5("input_ids").alias("ids_md5"), A.ints_md5("labels").alias("labels_md5"))


PAD_SQL = f"""{BASE}
SELECT conv_id, turn, CAST(len(input_ids) AS INTEGER) AS width, md5(array_to_string(input_ids, ',')) AS ids_md5, md5(array_to_string(labels, ',')) AS labels_md5 FROM tp"""


@register("p9_pad_to", sql=PAD_SQL)
def p9_pad_to(spark, sf):
    rows, _ = _rows(spark, sf)
    return rows.select(*KEYS, F.size("input_ids").alias("width"), A.ints_md5("input_ids").alias("ids_md5"), A.ints_md5("labels").alias("labels_md5"))


@register("p13_reshape_check", sql=PAD_SQL)
def p13_reshape_check(spark, sf):
    rows, _ = _rows(spark, sf, truncate_pad=False)
    d = pack.reshape_check(rows, B, EOS)
    return d.select(*KEYS, F.size("input_ids").alias("width"), A.ints_md5("input_ids").alias("ids_md5"), A.ints_md5("labels").alias("labels_md5"))


@register("p10_collate_causal", sql=f"""{BASE}
SELECT conv_id, turn, md5(array_to_string(list_transform(input_ids, lambda x: CASE WHEN x = {EOS} THEN -100 ELSE x END), ',')) AS labels_md5 FROM tp""")
def p10_collate_causal(spark, sf):
    rows, _ = _rows(spark, sf)
    d = pack.collate_causal(rows, EOS, "input_ids", "causal_labels")
    return d.select(*KEYS, A.ints_md5("causal_labels").alias("labels_md5"))


@register("p12_shift_labels", sql=f"""{BASE}
SELECT conv_id, turn, md5(array_to_string(labels[2:], ',')) AS shift_md5, CAST(len(list_filter(labels[2:], lambda x: x <> -100)) AS BIGINT) AS n_valid FROM tp""")
def p12_shift_labels(spark, sf):
    rows, _ = _rows(spark, sf)
    d = pack.shift_labels(rows, "labels", "shift_labels")
    return d.select(*KEYS, A.ints_md5("shift_labels").alias("shift_md5"), "n_valid")


NUM_SQL = f"""{BASE},
nr AS (SELECT conv_id, turn, input_ids, labels, row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_no, count(*) OVER () AS n FROM tp),
sp AS (SELECT *, CASE WHEN row_no < CAST(floor(n * {1.0 - VAL_RATIO}) AS BIGINT) THEN 'train' ELSE 'val' END AS split FROM nr)"""


@register("k3_split_rows", sql=f"{NUM_SQL} SELECT conv_id, turn, split FROM sp")
def k3_split_rows(spark, sf):
    rows, _ = _rows(spark, sf)
    d = splits.split_rows(rows, VAL_RATIO, KEYS)
    return d.select(*KEYS, "split")


@register("g2_dataset_sizes", sql=f"{NUM_SQL} SELECT split, count(*) AS n_rows FROM sp GROUP BY split")
def g2_dataset_sizes(spark, sf):
    """Sizes of the SFT splits (``groupBy("split").count()``)."""
    rows, _ = _rows(spark, sf)
    return splits.split_rows(rows, VAL_RATIO, KEYS).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def _split_frames(spark, sf):
    rows, v = _rows(spark, sf)
    d = cut_lineage(splits.split_rows(rows, VAL_RATIO, KEYS))
    n_train = d.filter(F.col("split") == "train").count()  # small scalar for the cursor arithmetic
    train = d.filter(F.col("split") == "train").withColumnRenamed("_idx", "row_no")
    val = d.filter(F.col("split") == "val").withColumn("row_no", F.col("_idx") - F.lit(n_train)).drop("_idx")
    return train, val, n_train, v


@register("k7_cyclic_batches", sql=f"""{NUM_SQL},
tr AS (SELECT conv_id, turn, row_no FROM sp WHERE split = 'train'),
nt AS (SELECT count(*) AS n FROM tr),
st AS (SELECT s AS step, (s * {BATCH}) % n AS b0, least((s * {BATCH}) % n + {BATCH}, n) AS b1 FROM range({STEPS}) r(s), nt)
SELECT st.step, tr.row_no, tr.conv_id, tr.turn FROM st JOIN tr ON tr.row_no >= st.b0 AND tr.row_no < st.b1""")
def k7_cyclic_batches(spark, sf):
    train, _, n_train, _ = _split_frames(spark, sf)
    d = splits.cyclic_batches(train.select("row_no", *KEYS), n_train, BATCH, STEPS)
    return d.select("step", "row_no", *KEYS)


@register("k8_first_batch", sql=f"""{NUM_SQL},
va AS (SELECT conv_id, turn, row_no - (SELECT count(*) FROM sp WHERE split = 'train') AS r FROM sp WHERE split = 'val')
SELECT conv_id, turn FROM va WHERE r < {BATCH}""")
def k8_first_batch(spark, sf):
    _, val, _, _ = _split_frames(spark, sf)
    n_val = val.count()
    return splits.first_batch(val, n_val, BATCH, "row_no").select(*KEYS)


MODEL_SQL = f"""{NUM_SQL},
mp AS (SELECT input_ids[i] AS prev, labels[i + 1] AS nxt FROM sp, range(1, {B}) r(i) WHERE split = 'train'),
pc AS (SELECT prev, nxt, count(*) AS c FROM mp WHERE nxt <> -100 GROUP BY prev, nxt),
pv AS (SELECT prev, sum(c) AS cp FROM pc GROUP BY prev),
vv AS (SELECT count(*) + 2 AS v FROM vocab),
fb AS (SELECT conv_id, turn, input_ids, labels FROM sp WHERE split = 'val')"""


def _sft_model(train):
    """Count model of the unmasked targets of the training rows."""
    pairs = sft.position_pairs(train, KEYS, "input_ids", "labels").where(F.col("target") != tokenizer.IGNORE_INDEX)
    return cut_lineage(ngram.fit_next_token(pairs.select("prev", F.col("target").alias("next"))))


def _val_losses(spark, sf, shifted=True):
    train, val, _, v = _split_frames(spark, sf)
    model = _sft_model(train)
    pairs = sft.position_pairs(val, KEYS, "input_ids", "labels", shifted=shifted)
    return sft.masked_losses(pairs, model, tokenizer.vocab_size(v))


POS_SHIFT = f"""pp AS (SELECT conv_id, turn, input_ids[i] AS prev, labels[i + 1] AS target FROM fb, range(1, {B}) r(i))"""
POS_SAME = f"""pp AS (SELECT conv_id, turn, input_ids[i] AS prev, labels[i] AS target FROM fb, range(1, {B + 1}) r(i))"""
LOSS_SQL = """ls AS (SELECT pp.conv_id, pp.turn, pp.target <> -100 AS valid,
                     CASE WHEN pp.target <> -100 THEN -ln((coalesce(pc.c, 0) + 1.0) / (coalesce(pv.cp, 0) + 1.0 * vv.v)) END AS loss
              FROM pp LEFT JOIN pc ON pc.prev = pp.prev AND pc.nxt = pp.target LEFT JOIN pv ON pv.prev = pp.prev, vv)"""


@register("g6_masked_mean_loss", sql=f"""{MODEL_SQL}, {POS_SHIFT}, {LOSS_SQL}
SELECT conv_id, turn, CAST(sum(CAST(valid AS BIGINT)) AS BIGINT) AS n_valid,
       round(coalesce(sum(loss) / nullif(sum(CAST(valid AS BIGINT)), 0), 0.0), 6) AS masked_loss FROM ls GROUP BY conv_id, turn""")
def g6_masked_mean_loss(spark, sf):
    """Shifted, masked loss of every validation row under a count model
    of the training rows' targets."""
    return sft.masked_mean_loss(_val_losses(spark, sf, True), KEYS, guard=True)


@register("g7_unshifted_masked_loss", sql=f"""{MODEL_SQL}, {POS_SAME}, {LOSS_SQL}
SELECT CAST(sum(CAST(valid AS BIGINT)) AS BIGINT) AS n_valid, round(sum(loss) / nullif(sum(CAST(valid AS BIGINT)), 0), 6) AS masked_loss FROM ls""")
def g7_unshifted_masked_loss(spark, sf):
    """The older loss (label at the same position), one value for the
    whole validation split, no zero guard."""
    return sft.masked_mean_loss(_val_losses(spark, sf, False), (), guard=False)


@register("g9_perplexity", sql=f"""{MODEL_SQL}, {POS_SHIFT}, {LOSS_SQL},
bl AS (SELECT coalesce(sum(loss) / nullif(sum(CAST(valid AS BIGINT)), 0), 0.0) AS l FROM ls)
SELECT round(l, 6) AS val_loss, round(exp(l), 6) AS perplexity FROM bl""")
def g9_perplexity(spark, sf):
    """Validation perplexity of the SFT split = exp(masked mean loss)."""
    l = sft.masked_mean_loss(_val_losses(spark, sf, True), (), guard=True, digits=12)
    return l.select(F.round("masked_loss", 6).alias("val_loss"), F.round(F.exp("masked_loss"), 6).alias("perplexity"))
