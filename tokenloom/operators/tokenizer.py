"""Tokenizer jobs (T2-T12, J1, J5): vocabulary tables and encode/decode.

A vocabulary is a DataFrame ``(token string, id int, special boolean)``; its
size is bounded by the ``vocab_size`` parameter, which is what makes shipping
it with the functions of :func:`encode`/:func:`decode` safe at any corpus size.

Word-level tokenization takes white-space words (``str.split()``); the trained
BPE codec lives in :mod:`tokenloom.operators.bpe`.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from tokenloom.functions import text as T
from tokenloom.session import cut_lineage

# --- fixed values -----------------------------------------------------------
# Special tokens of the reference tokenizers, in the order given to the
# trainer: the end-of-text token (also the padding token of the SFT and
# packaged-trainer paths) and the BPE padding token.
END_TOKEN = "<|endoftext|>"
PAD_TOKEN = "<pad>"
DEFAULT_SPECIALS = (END_TOKEN, PAD_TOKEN)
IGNORE_INDEX = -100
# ---------------------------------------------------------------------------

VOCAB_SCHEMA = Ty.StructType(
    [
        Ty.StructField("token", Ty.StringType(), False),
        Ty.StructField("id", Ty.IntegerType(), False),
        Ty.StructField("special", Ty.BooleanType(), False),
    ]
)


def specials_frame(spark, specials=DEFAULT_SPECIALS) -> DataFrame:
    """Special tokens with ids 0.. in the order given."""
    return spark.createDataFrame([(t, i, True) for i, t in enumerate(specials)], VOCAB_SCHEMA)


def word_counts(df: DataFrame, col: str = "text") -> DataFrame:
    """G3 (word level): ``(token, count)``; map-side partial counts before the shuffle."""
    return df.select(F.explode(T.whitespace_words(col)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("count"))


def build_vocab(df: DataFrame, col: str = "text", vocab_size: int = 32000, specials=DEFAULT_SPECIALS,
                min_count: int = 1) -> DataFrame:
    """T2 (word level): specials first in the order given, then the most
    frequent words (ties by token, binary order) up to ``vocab_size`` ids.

    The ranking is a distributed top-k (``TakeOrderedAndProject``: each
    partition keeps its best k, one merge); the numbering window runs over
    at most ``vocab_size`` rows.
    """
    spark = df.sparkSession
    specials = list(specials)
    k = max(0, vocab_size - len(specials))
    counts = word_counts(df, col).filter(F.col("count") >= F.lit(min_count)).filter(~F.col("token").isin(specials))
    top = counts.orderBy(F.col("count").desc(), F.col("token").asc()).limit(k)
    w = Window.orderBy(F.col("count").desc(), F.col("token").asc())
    words = top.select("token", (F.row_number().over(w) - 1 + F.lit(len(specials))).cast("int").alias("id"), F.lit(False).alias("special"))
    return specials_frame(spark, specials).unionByName(words)


def add_special_token(vocab: DataFrame, token: str) -> DataFrame:
    """Add ``token`` as a special with id ``max(id)+1`` only when absent."""
    spark = vocab.sparkSession
    cand = spark.createDataFrame([(token,)], "token string")
    missing = cand.join(vocab.select("token"), "token", "left_anti")
    nxt = vocab.agg(F.coalesce(F.max("id") + 1, F.lit(0)).cast("int").alias("id"))
    add = missing.join(F.broadcast(nxt.withColumn("_k", F.lit(1))), F.lit(1) == F.col("_k")).select(
        "token", "id", F.lit(True).alias("special")
    )
    return vocab.unionByName(add)


def token_id(vocab: DataFrame, token: str) -> DataFrame:
    """Id of a token (zero or one row)."""
    return vocab.filter(F.col("token") == F.lit(token)).select("id")


def vocab_size(vocab: DataFrame) -> DataFrame:
    """Number of ids."""
    return vocab.agg(F.count(F.lit(1)).cast("long").alias("vocab_size"))


def _regrouped(rows: DataFrame, keys: list[str], col: str) -> DataFrame:
    """One row per ``keys`` with the non-null elements of the arrays ``col``.
    Rows that share their keys (rare) are merged by position, then value."""
    l = rows.repartition(*keys).groupBy(*keys).agg(F.collect_list(col).alias("_l"))
    one = F.filter(F.element_at("_l", 1), lambda x: x.isNotNull())
    placed = F.flatten(F.transform("_l", lambda a: F.transform(a, lambda x, i: F.struct(i.alias("p"), x.alias("x")))))
    merged = F.transform(F.array_sort(F.filter(placed, lambda e: e["x"].isNotNull())), lambda e: e["x"])
    return l.select(*keys, F.when(F.size("_l") == 1, one).otherwise(merged).alias(col))


def encode(df: DataFrame, vocab: DataFrame, key: str = "doc_id", col: str = "text", out: str = "ids",
           carry=None) -> DataFrame:
    """T4 / J1 (word level): text -> ``array<int>`` of vocabulary ids.

    Words outside the vocabulary disappear (as characters outside a trained
    BPE alphabet do).  The bounded vocabulary is shipped with the function that
    looks the words up, so a text's ids come from its own row and the one
    shuffle (rows that share a key come together) moves ids: no row for each
    word is shuffled or sorted.  ``carry`` columns (small ones: language,
    split...) ride along as grouping keys.
    """
    keys = [key] if isinstance(key, str) else list(key)
    carry = [c for c in (carry if carry is not None else df.columns) if c not in (*keys, col)]
    ids = {r["token"]: r["id"] for r in vocab.select("token", "id").collect()}

    @F.pandas_udf("array<int>")
    def look_up(texts: pd.Series) -> pd.Series:
        return pd.Series([[ids.get(w) for w in t.split()] if t else [] for t in texts], dtype=object)

    rows = df.select(*keys, *carry, look_up(col).alias("_ids"))
    return _regrouped(rows, [*keys, *carry], "_ids").withColumnRenamed("_ids", out)


def decode(df: DataFrame, vocab: DataFrame, key: str = "doc_id", ids: str = "ids", out: str = "text",
           skip_special: bool = True, sep: str = " ") -> DataFrame:
    """Ids -> text, special ids removed, tokens joined with ``sep``.
    As in :func:`encode` the vocabulary goes to the rows."""
    keys = [key] if isinstance(key, str) else list(key)
    kept = vocab.filter(~F.col("special")) if skip_special else vocab
    tokens = {r["id"]: r["token"] for r in kept.select("id", "token").collect()}

    @F.pandas_udf("array<string>")
    def spell(rows: pd.Series) -> pd.Series:
        return pd.Series([[tokens.get(i) for i in r] if r is not None else [] for r in rows], dtype=object)

    rows = _regrouped(df.select(*keys, spell(ids).alias("_t")), keys, "_t")
    return rows.select(*keys, F.array_join("_t", sep).alias(out))


def drop_special(df: DataFrame, vocab: DataFrame, ids: str = "ids") -> DataFrame:
    """J5 (array form): remove special ids from an id array.  The specials
    set is tiny, so it is inlined as a literal array (no join at all)."""
    spec = [r["id"] for r in vocab.filter("special").select("id").collect()]
    lit = F.array(*[F.lit(int(i)) for i in spec]) if spec else F.array().cast("array<int>")
    return df.withColumn(ids, F.filter(ids, lambda x: ~F.array_contains(lit, x)))


def count_tokens(df: DataFrame, ids: str = "ids", block: int = 64) -> DataFrame:
    """Exact token total and the total aligned down to the block."""
    n = F.coalesce(F.sum(F.size(ids).cast("long")), F.lit(0))
    return df.agg(n.alias("n_tokens")).withColumn("n_aligned", F.col("n_tokens") - F.col("n_tokens") % F.lit(block))


def token_preview(df: DataFrame, ids: str = "ids", n: int = 20, out: str = "preview") -> DataFrame:
    """The first ``n`` tokens."""
    return df.withColumn(out, F.slice(ids, 1, n))


def attention_mask(df: DataFrame, ids: str = "ids", out: str = "attention_mask") -> DataFrame:
    """1 for every real token."""
    return df.withColumn(out, F.transform(ids, lambda x: F.lit(1)))


def pad_batch(df: DataFrame, batch_cols, ids: str = "ids", pad_id: int = 1, mask: str = "attention_mask") -> DataFrame:
    """Right-pad every row to the longest row of its batch; mask 1/0.

    The window is partitioned by the batch (bounded by the batch size)."""
    batch_cols = [batch_cols] if isinstance(batch_cols, str) else list(batch_cols)
    w = Window.partitionBy(*batch_cols)
    longest = F.max(F.size(ids)).over(w)
    d = df.withColumn("_pad", longest - F.size(ids))
    d = d.withColumn(mask, F.concat(F.transform(ids, lambda x: F.lit(1)), F.array_repeat(F.lit(0), F.col("_pad"))))
    d = d.withColumn(ids, F.concat(F.col(ids), F.array_repeat(F.lit(pad_id), F.col("_pad"))))
    return d.drop("_pad")


def estimate_tokens(chunks: DataFrame, vocab: DataFrame | None = None, order: str = "chunk_id", col: str = "text",
                    sample_chars: int = 10 * 1024 * 1024, block: int = 64) -> DataFrame:
    """Tokens of the first ``sample_chars`` characters of the corpus file
    (the concatenation of chunk texts in ``order``), scaled by total UTF-8
    bytes / sample bytes, floored, aligned down to the block.

    The prefix is found with a bucketed character prefix sum.  Word-level
    count: with a vocabulary, only in-vocabulary words count (they are the
    tokens); without one, every white-space word does.
    """
    from tokenloom.operators.positions import ROW_ID, attach_scalars, prefix_sum

    staged = [ROW_ID] if ROW_ID in chunks.columns else []
    d = chunks.select(*staged, order, col).withColumn("_len", T.char_len(col))
    d = prefix_sum(d, "_len", [order], out="_off")
    take = F.greatest(F.lit(0), F.least(F.col("_len"), F.lit(sample_chars) - F.col("_off")))
    d = d.withColumn("_part", F.substring(col, 1, take)).withColumn("_bytes", T.byte_len(col))
    words = T.whitespace_words("_part")
    if vocab is not None:
        toks = d.select(F.explode(words).alias("token")).join(F.broadcast(vocab.select("token")), "token")
        n_tok = toks.agg(F.count(F.lit(1)).alias("sample_tokens"))
    else:
        n_tok = d.agg(F.sum(F.size(words)).alias("sample_tokens"))
    sizes = d.agg(F.sum("_bytes").alias("total_bytes"), F.sum(T.byte_len("_part")).alias("sample_bytes"))
    r = attach_scalars(sizes, n_tok)
    est = F.floor(F.col("sample_tokens") * (F.col("total_bytes") / F.col("sample_bytes"))).cast("long")
    r = r.withColumn("estimated", F.when(F.col("sample_bytes") > 0, est).otherwise(F.lit(0).cast("long")))
    return r.withColumn("estimated_aligned", F.col("estimated") - F.col("estimated") % F.lit(block))


def doc_line_groups(docs: DataFrame, key: str = "doc_id", col: str = "text", n_lines: int = 20000,
                    key_source: DataFrame | None = None) -> DataFrame:
    """T9 grouping straight from documents (the corpus file is the documents'
    lines in ``key`` order).  Same rule as :func:`line_groups`, linear in the
    lines: the texts are stored once, two scans over keys and counts give each
    document the number of its first line and of the groups closed before it,
    and each document comes out as its stretches between boundary lines."""
    from tokenloom.operators.positions import ROW_ID, prefix_sum, stage_rows

    lines = F.split(F.col("_t"), "\n", -1)
    rows = docs.select(key, F.coalesce(F.col(col), F.lit("")).alias("_t"))
    rows = stage_rows(rows.withColumn("_n", F.size(lines).cast("long")), "line-docs")
    at = prefix_sum(rows.select(ROW_ID, key, "_n"), "_n", [key], out="_off", key_source=key_source)
    # Boundary lines of a document: every n_lines-th line of the corpus that is not blank.
    first = F.lit(n_lines - 1) - F.col("_off") % F.lit(n_lines)
    due = F.when(first < F.col("_n"), F.sequence(first, F.col("_n") - 1, F.lit(n_lines).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    marks = rows.select(ROW_ID, "_t").join(at, ROW_ID).select(ROW_ID, key, "_off", "_n", lines.alias("_ls"), due.alias("_due"))
    ends = F.filter("_due", lambda k: F.length(T.strip(F.element_at("_ls", (k + 1).cast("int")))) > 0)
    marks = cut_lineage(marks.select(ROW_ID, key, "_off", "_n", ends.alias("_ends")), "line-marks")
    closed = prefix_sum(marks.select(ROW_ID, key, F.size("_ends").alias("_nf")), "_nf", [key], out="_closed", key_source=key_source)
    d = rows.select(ROW_ID, "_t").join(marks.drop(key), ROW_ID).join(closed.select(ROW_ID, "_closed"), ROW_ID)
    cuts = F.concat(F.array(F.lit(-1).cast("long")), "_ends", F.array(F.col("_n") - 1))
    d = d.select("_off", "_closed", lines.alias("_ls"), cuts.alias("_cuts"))
    d = d.select("_off", "_closed", "_ls", "_cuts", F.posexplode(F.slice("_cuts", 2, F.size("_cuts") - 1)).alias("_i", "_last"))
    start = F.element_at("_cuts", F.col("_i") + 1) + 1
    part = F.slice("_ls", (start + 1).cast("int"), (F.col("_last") - start + 1).cast("int"))
    kept = F.filter(F.transform(part, T.strip), lambda x: F.length(x) > 0)
    d = d.select((F.col("_closed") + F.col("_i")).alias("group_id"), (F.col("_off") + start).alias("line_no"), kept.alias("_s")).filter(F.size("_s") > 0)
    return d.groupBy("group_id").agg(
        F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "_s"))), lambda x: x["_s"])), " ").alias("text")
    )


def line_groups(lines: DataFrame, line_no: str = "line_no", col: str = "line", n_lines: int = 20000) -> DataFrame:
    """T9 grouping: lines are stripped and blanks skipped *before* the flush
    test, so a blank boundary line (``(i+1) % n == 0``) extends the group to
    the next non-blank boundary.  Group id = number of earlier non-blank
    boundary lines (bucketed running count).  Output ``(group_id, text)``:
    the group's lines joined with a space, in line order.
    """
    from tokenloom.operators.positions import prefix_sum

    d = lines.select(line_no, T.strip(col).alias("_s"))
    nonblank = F.length("_s") > 0
    d = d.withColumn("_b", F.when(nonblank & (((F.col(line_no) + 1) % F.lit(n_lines)) == 0), F.lit(1)).otherwise(F.lit(0)))
    d = prefix_sum(d, "_b", [line_no], out="group_id").filter(nonblank)
    return d.groupBy("group_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(line_no, "_s"))), lambda x: x["_s"]), " ").alias("text")
    )
