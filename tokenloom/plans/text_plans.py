"""Registered queries: scans (S1-S6, U1), filters (F1-F9), augmentation
(A1-A8) and string functions (X1-X11) over the driver's text tables."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tokenloom.functions import text as T
from tokenloom.operators import augment, filters
from tokenloom.plans import flagship as FL
from tokenloom.plans import sqlparts as S
from tokenloom.plans.registry import register, table
from tokenloom.sources import corpus

SEED, P = FL.SEED, FL.DROP_P


def _docs(spark, sf):
    return table(spark, sf, "documents")


def _filtered(spark, sf):
    """Stripped documents passing F3+F4 (input of the sentence operators)."""
    d = filters.strip_text(_docs(spark, sf).select("doc_id", "lang", "text"))
    return d.filter(filters.quality_predicate("text", FL.MIN_CHARS, T.EN_COUNT_DELIM, FL.MIN_MARKS))


# --- S: scans -----------------------------------------------------------------

@register("s1_scan_corpus", sql="SELECT doc_id, md5(coalesce(text, '')) AS text_md5, length(coalesce(text, '')) AS n_chars FROM documents")
def s1_scan_corpus(spark, sf):
    d = corpus.scan_corpus(spark, f"{sf}/documents.parquet", "text", "doc_id")
    return d.select("doc_id", F.md5("text").alias("text_md5"), T.char_len("text").alias("n_chars"))


@register("s2_scan_splits", sql="""
SELECT 'train' AS split, 0 AS split_rank, doc_id, length(text) AS n_chars FROM documents
UNION ALL SELECT 'validation', 1, item_id, length(text) FROM benchmark""")
def s2_scan_splits(spark, sf):
    frames = {
        "train": _docs(spark, sf).select("doc_id", "text"),
        "validation": table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text"),
    }
    d = corpus.scan_splits(frames, "train+validation")
    return d.select("split", "split_rank", "doc_id", T.char_len("text").alias("n_chars"))


CONCAT_SQL = """
SELECT 'documents' AS source_name, 0 AS source_rank, doc_id AS rec_id, length(text) AS n_chars FROM documents
UNION ALL SELECT 'benchmark', 1, item_id, length(text) FROM benchmark
UNION ALL SELECT 'pages', 2, page_id, length(html) FROM pages"""


def _concat(spark, sf):
    return corpus.concat_corpora([
        ("documents", _docs(spark, sf).select(F.col("doc_id").alias("rec_id"), "text")),
        ("benchmark", table(spark, sf, "benchmark").select(F.col("item_id").alias("rec_id"), "text")),
        ("pages", table(spark, sf, "pages").select(F.col("page_id").alias("rec_id"), F.col("html").alias("text"))),
    ])


@register("s3_concat_corpora", sql=CONCAT_SQL)
def s3_concat_corpora(spark, sf):
    return _concat(spark, sf).select("source_name", "source_rank", "rec_id", T.char_len("text").alias("n_chars"))


@register("u1_union_all", sql="SELECT doc_id AS rec_id, lang FROM documents UNION ALL SELECT item_id, NULL FROM benchmark UNION ALL SELECT doc_id, lang FROM documents")
def u1_union_all(spark, sf):
    d = _docs(spark, sf).select(F.col("doc_id").alias("rec_id"), "lang")
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("rec_id"))
    return corpus.union_all([d, b, d])


@register("s5_scan_lines", sql=f"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
x AS (SELECT doc_id, unnest(ls) AS raw, generate_subscripts(ls, 1) - 1 AS line_no FROM l)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, md5({S.strip('raw')}) AS line_md5 FROM x WHERE length({S.strip('raw')}) > 0""")
def s5_scan_lines(spark, sf):
    d = corpus.scan_lines(_docs(spark, sf), "doc_id", "text")
    return d.select("doc_id", "line_no", F.md5("line").alias("line_md5"))


HEAD_SQL = "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100"


@register("s6_head_rows", sql=HEAD_SQL)
def s6_head_rows(spark, sf):
    return corpus.head_rows(_docs(spark, sf).select("doc_id", "lang"), 100, ["doc_id"])


register("o4_head_rows", sql=HEAD_SQL)(s6_head_rows)


# --- F: filters ---------------------------------------------------------------

@register("f1_drop_blank", sql=f"SELECT doc_id FROM documents WHERE regexp_matches(text, '{S.NON_WS}')")
def f1_drop_blank(spark, sf):
    return filters.drop_blank(_docs(spark, sf)).select("doc_id")


@register("f2_strip_text", sql=f"SELECT doc_id, md5({S.strip('text')}) AS text_md5, length({S.strip('text')}) AS n_chars FROM documents")
def f2_strip_text(spark, sf):
    d = filters.strip_text(_docs(spark, sf))
    return d.select("doc_id", F.md5("text").alias("text_md5"), T.char_len("text").alias("n_chars"))


@register("f3_min_length", sql="SELECT doc_id FROM documents WHERE length(text) > 100")
def f3_min_length(spark, sf):
    return filters.min_length(_docs(spark, sf), "text", 100).select("doc_id")


@register("f4_min_delims", sql=f"SELECT doc_id, {S.count_lit('text', '.')} AS n_marks FROM documents WHERE {S.count_lit('text', '.')} > 2")
def f4_min_delims(spark, sf):
    d = filters.min_delims(_docs(spark, sf), "text", ".", 2)
    return d.select("doc_id", T.count_literal("text", ".").alias("n_marks"))


LATIN1_CLASS = "[\\x{C0}-\\x{FF}]"


@register("f5_has_script_latin1", sql=f"SELECT doc_id FROM documents WHERE regexp_matches(coalesce(text, '') || coalesce(lang, ''), '{LATIN1_CLASS}')")
def f5_has_script_latin1(spark, sf):
    """F5 with a Latin-1 letter class (the driver's corpus has no kana/CJK)."""
    return filters.has_script(_docs(spark, sf), ["text", "lang"], LATIN1_CLASS).select("doc_id")


@register("f7_project", sql="SELECT doc_id, lang FROM documents")
def f7_project(spark, sf):
    return filters.drop_cols(filters.project(_docs(spark, sf), ["doc_id", "lang", "source"]), ["source"])


@register("f8_text_size", sql="SELECT doc_id, length(text) AS n_codepoints, strlen(text) AS n_bytes FROM documents")
def f8_text_size(spark, sf):
    return filters.text_size(_docs(spark, sf)).select("doc_id", "n_codepoints", "n_bytes")


@register("f9_filter_rows", sql="SELECT doc_id FROM documents WHERE lang = 'en' AND n_chars > 1000")
def f9_filter_rows(spark, sf):
    obs = Observation("f9_rows")
    return filters.filter_rows(_docs(spark, sf), (F.col("lang") == "en") & (F.col("n_chars") > 1000), obs).select("doc_id")


@register("x_string_functions", sql=f"""
SELECT doc_id, {S.count_lit('text', 'the')} AS n_the, length(text) AS n_chars, strlen(text) AS n_bytes,
       printf('%07d', doc_id) AS padded, md5(substring(text, 1, 120)) AS preview_md5,
       regexp_matches(text, '{S.NON_WS}') AS non_blank, md5(string_split(text, ' ')[1]) AS first_piece_md5
FROM documents""")
def x_string_functions(spark, sf):
    d = _docs(spark, sf)
    return d.select(
        "doc_id",
        T.count_literal("text", "the").alias("n_the"),
        T.char_len("text").alias("n_chars"),
        T.byte_len("text").alias("n_bytes"),
        T.zero_padded("doc_id", 7).alias("padded"),
        F.md5(T.preview("text", 120)).alias("preview_md5"),
        T.has_non_space("text").alias("non_blank"),
        F.md5(F.element_at(T.split_literal("text", " "), 1)).alias("first_piece_md5"),
    )


# --- A: augmentation ----------------------------------------------------------

F_SQL = f"""
docs AS (SELECT doc_id, lang, {S.strip("coalesce(text, '')")} AS t FROM documents),
f AS (SELECT doc_id, lang, t FROM docs WHERE length(t) > {FL.MIN_CHARS} AND {S.count_lit('t', '.')} > {FL.MIN_MARKS}),
sl AS (SELECT doc_id, lang, string_split(t, '. ') AS l FROM f),
s AS (SELECT doc_id, lang, unnest(l) AS sent, generate_subscripts(l, 1) - 1 AS pos FROM sl)"""


@register("a1_split_sentences", sql=f"WITH {F_SQL} SELECT doc_id, CAST(pos AS INTEGER) AS pos, md5(sent) AS sent_md5 FROM s")
def a1_split_sentences(spark, sf):
    d = augment.split_sentences(_filtered(spark, sf), "doc_id", "text", T.EN_SENTENCE_DELIM)
    return d.select("doc_id", "pos", F.md5("sent").alias("sent_md5"))


@register("a3_shuffle_within", sql=f"""WITH {F_SQL}
SELECT doc_id, CAST(pos AS INTEGER) AS pos,
       CAST(row_number() OVER (PARTITION BY doc_id ORDER BY {S.khash(SEED, 'shuffle', 'doc_id', 'pos')}, pos) - 1 AS INTEGER) AS new_pos
FROM s""")
def a3_shuffle_within(spark, sf):
    d = augment.split_sentences(_filtered(spark, sf))
    return augment.shuffle_within(d, "doc_id", "pos", "sent", SEED).select("doc_id", "pos", "new_pos")


@register("a4_shuffle_global", sql=f"""WITH {F_SQL}
SELECT doc_id, CAST(pos AS INTEGER) AS pos,
       row_number() OVER (ORDER BY {S.khash(SEED, 'gshuffle', 'doc_id', 'pos')}, doc_id, pos) - 1 AS "order"
FROM s""")
def a4_shuffle_global(spark, sf):
    d = augment.split_sentences(_filtered(spark, sf))
    return augment.shuffle_global(d, ["doc_id", "pos"], SEED, "order").select("doc_id", "pos", "order")


@register("a5_drop_random", sql=f"""WITH {F_SQL}
SELECT doc_id, CAST(pos AS INTEGER) AS pos FROM s WHERE {S.khash(SEED, 'drop', 'doc_id', 'pos')} / 4294967296.0 > {P}""")
def a5_drop_random(spark, sf):
    d = augment.split_sentences(_filtered(spark, sf))
    return augment.drop_random(d, P, SEED, ["doc_id", "pos"]).select("doc_id", "pos")


AUG_SQL = f"WITH {FL.PREPARED_SQL} SELECT doc_id, md5(text) AS text_md5, length(text) AS n_chars FROM aug"


@register("a6_rejoin", sql=AUG_SQL)
def a6_rejoin(spark, sf):
    """A1 -> A5 -> A3 -> A6 in exploded form (equals the fused array form)."""
    docs = _filtered(spark, sf)
    s = augment.split_sentences(docs)
    s = augment.drop_random(s, P, SEED, ["doc_id", "pos"])
    s = augment.shuffle_within(s, "doc_id", "pos", "sent", SEED)
    r = augment.rejoin(s, docs, "doc_id", "new_pos", "sent", T.EN_SENTENCE_DELIM)
    return r.select("doc_id", F.md5("text").alias("text_md5"), T.char_len("text").alias("n_chars"))


@register("a2_corpus_sentences", sql=f"""
WITH j AS (SELECT string_agg(text, ' ' ORDER BY doc_id) AS t FROM documents WHERE regexp_matches(text, '{S.NON_WS}')),
l AS (SELECT string_split(t, '. ') AS ls FROM j)
SELECT generate_subscripts(ls, 1) - 1 AS sent_id, md5(unnest(ls)) AS sent_md5 FROM l""")
def a2_corpus_sentences(spark, sf):
    d = filters.drop_blank(_docs(spark, sf).select("doc_id", "text"))
    s = augment.corpus_sentences(d, "doc_id", "text", T.EN_SENTENCE_DELIM, " ")
    return s.select("sent_id", F.md5("sent").alias("sent_md5"))


CHUNK = 1000
CHUNK_SQL = f"""WITH {FL.PREPARED_SQL},
rec AS (
  SELECT d.doc_id, row_number() OVER (ORDER BY d.doc_id) - 1 AS rn, a.text, a.doc_id IS NOT NULL AS passed
  FROM documents d LEFT JOIN aug a USING (doc_id)
),
ch AS (
  SELECT rn // {CHUNK} AS chunk_id, count(*) AS n_records,
         coalesce(string_agg(text, ' ' ORDER BY rn) FILTER (WHERE passed), '') AS body,
         count(*) FILTER (WHERE passed) AS n_passed
  FROM rec GROUP BY rn // {CHUNK}
),
chunks AS (
  SELECT chunk_id, CASE WHEN n_records = {CHUNK} THEN body || ' ' ELSE body END AS text, n_records, n_records = {CHUNK} AS is_full
  FROM ch WHERE n_records = {CHUNK} OR n_passed > 0
)"""


def chunks(spark, sf):
    d = augment.prepare_documents(_docs(spark, sf).select("doc_id", "lang", "text"), "doc_id", "text", FL.MIN_CHARS,
                                  T.EN_COUNT_DELIM, FL.MIN_MARKS, T.EN_SENTENCE_DELIM, P, SEED, flag="passed")
    return augment.assemble_chunks(d, "doc_id", "text", "passed", CHUNK, " ")


@register("a7_assemble_chunks", sql=CHUNK_SQL + " SELECT chunk_id, md5(text) AS text_md5, length(text) AS n_chars, n_records, is_full FROM chunks")
def a7_assemble_chunks(spark, sf):
    c = chunks(spark, sf)
    return c.select("chunk_id", F.md5("text").alias("text_md5"), T.char_len("text").alias("n_chars"), "n_records", "is_full")


register("g11_chunk_concat", sql=CHUNK_SQL + " SELECT chunk_id, md5(text) AS text_md5, length(text) AS n_chars, n_records, is_full FROM chunks")(a7_assemble_chunks)

TOTALS_SQL = CHUNK_SQL + """
SELECT CAST(coalesce(sum(length(text) - CASE WHEN is_full THEN 1 ELSE 0 END), 0) AS BIGINT) AS total_chars, count(*) AS n_chunks FROM chunks"""


@register("a8_corpus_totals", sql=TOTALS_SQL)
def a8_corpus_totals(spark, sf):
    return augment.corpus_totals(chunks(spark, sf))


register("g1_total_size", sql=TOTALS_SQL)(a8_corpus_totals)
