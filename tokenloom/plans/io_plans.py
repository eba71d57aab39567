"""Registered queries: sinks and stage guards (S7-S14), streaming (S4,
ST1-ST5), BPE training/encoding (T1, T4 BPE path) and generation (M5).

Each sink query writes under the shared checkpoint folder and returns what
it reads back, so the check covers the stored table, not the plan."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tokenloom.functions import arrays as A
from tokenloom.functions import text as T
from tokenloom.operators import augment, bpe, generate, ngram, splits, tokenizer
from tokenloom.plans import flagship as FL
from tokenloom.plans import metric_plans as MP
from tokenloom.plans import text_plans as TP
from tokenloom.plans import token_plans as KP
from tokenloom.plans.registry import register, table
from tokenloom.session import cut_lineage, stage_path
from tokenloom.sources import corpus, sinks
from tokenloom.streaming import early_stop, prepare

def _out_text():
    return ["doc_id", F.md5("text").alias("text_md5"), T.char_len("text").alias("n_chars")]


@register("s7_write_corpus", sql=TP.CHUNK_SQL + " SELECT chunk_id, md5(text) AS text_md5, length(text) AS n_chars FROM chunks")
def s7_write_corpus(spark, sf):
    path = stage_path(spark, "corpus")
    sinks.write_corpus(TP.chunks(spark, sf), path)
    back = spark.read.parquet(path)
    return back.select("chunk_id", F.md5("text").alias("text_md5"), T.char_len("text").alias("n_chars"))


@register("s7_write_text", sql=TP.CHUNK_SQL + """,
cl AS (SELECT chunk_id, string_split(text, chr(10)) AS ls FROM chunks),
cx AS (SELECT chunk_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS k FROM cl)
SELECT row_number() OVER (ORDER BY chunk_id, k) - 1 AS line_no, md5(line) AS line_md5, length(line) AS n_chars FROM cx""")
def s7_write_text(spark, sf):
    """The corpus as plain text files, read back line by line in file order."""
    path = stage_path(spark, "corpus-text")
    sinks.write_corpus(TP.chunks(spark, sf), path, fmt="text")
    back = corpus.scan_text_lines(spark, path, keep_blank=True, whole=True)
    return back.select("line_no", F.md5("line").alias("line_md5"), T.char_len("line").alias("n_chars"))


@register("s5_scan_text_lines", sql=f"""WITH {KP.LINES_SQL.strip()} SELECT line_no, md5(line) AS line_md5 FROM ln WHERE length(line) > 0""")
def s5_scan_text_lines(spark, sf):
    """S5 path form: the documents' texts as text files, numbered through all
    files, blank lines counted and dropped."""
    path = stage_path(spark, "documents-text")
    docs = table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sinks.write_corpus(docs, path, "doc_id", "text", fmt="text")
    return corpus.scan_text_lines(spark, path, whole=True).select("line_no", F.md5("line").alias("line_md5"))


@register("s8_write_blocks", sql=KP.BLOCKS_SQL)
def s8_write_blocks(spark, sf):
    blocks, _ = FL.lm_blocks(spark, sf, lookahead=0)
    path = stage_path(spark, "blocks")
    sinks.write_blocks(blocks, path, ["lang"])
    return spark.read.parquet(path).select("lang", "block_id", A.ints_md5("tokens").alias("tokens_md5"))


@register("s9_write_if_absent", sql=TP.AUG_SQL)
def s9_write_if_absent(spark, sf):
    path = stage_path(spark, "prepared")
    sinks.write_if_absent(FL.prepared_docs(spark, sf), path)
    again = sinks.write_if_absent(FL.prepared_docs(spark, sf), path)  # present: skipped, no job planned
    return again.select(*_out_text())


@register("s10_mirror_output", sql=TP.AUG_SQL)
def s10_mirror_output(spark, sf):
    path, path2 = stage_path(spark, "prepared"), stage_path(spark, "mirror")
    sinks.write_if_absent(FL.prepared_docs(spark, sf), path)
    return sinks.mirror_output(spark, path, path2).select(*_out_text())


@register("s11_require_nonempty", sql=f"WITH {FL.PREPARED_SQL} SELECT count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM aug")
def s11_require_nonempty(spark, sf):
    p = FL.prepared_docs(spark, sf, materialize=True)
    sinks.require_nonempty(p, "prepared corpus")
    sinks.require_nonempty(p.select(T.char_len("text").alias("n")), "prepared corpus", "n")
    return p.agg(F.count(F.lit(1)).alias("n_docs"), F.sum(T.char_len("text")).alias("n_chars"))


@register("s12_bpe_roundtrip", sql="""
SELECT count(*) AS n_differing_rows FROM documents WHERE false""")
def s12_bpe_roundtrip(spark, sf):
    """Vocabulary and merges of the trained tokenizer, saved, loaded again and
    compared row by row with what was saved."""
    path = stage_path(spark, "bpe-tokenizer")
    vocab, merges = _bpe(spark, sf)
    if merges.isEmpty():
        raise ValueError("no merges to save")
    bpe.load_tokenizer(spark, path, lambda: (vocab, merges))
    back = bpe.load_tokenizer(spark, path)
    lost = [a.exceptAll(b).unionByName(b.exceptAll(a)).agg(F.count(F.lit(1)).alias("n")) for a, b in zip((vocab, merges), back)]
    return lost[0].unionByName(lost[1]).agg(F.sum("n").alias("n_differing_rows"))


@register("s12_tokenizer_roundtrip", sql=f"{KP.BASE} SELECT token, id, special FROM {KP._vocab_sql_full()}")
def s12_tokenizer_roundtrip(spark, sf):
    path = stage_path(spark, "tokenizer")
    empty = spark.createDataFrame([], bpe.MERGES_SCHEMA)
    built = {}

    def build():
        built["n"] = 1
        return FL.vocab(spark, sf), empty

    bpe.load_tokenizer(spark, path, build)  # absent: built and saved
    vocab, _ = bpe.load_tokenizer(spark, path, build)  # present: loaded
    return vocab


@register("s13_append_metrics", sql=f"{MP.BASE} SELECT run_id, step, 'loss' AS name, loss AS value FROM ms")
def s13_append_metrics(spark, sf):
    steps = MP.metric_steps(spark, sf).select("run_id", "step", F.lit("loss").alias("name"), F.col("loss").alias("value"))
    path = stage_path(spark, "metrics")
    sinks.append_metrics(steps.filter(F.col("step") < 30).withColumn("value", F.col("value") + 1.0), path, attempt=1)  # interrupted run
    sinks.append_metrics(steps, path, attempt=2)  # resumed run rewrites its steps
    return sinks.read_metrics(spark, path, ["run_id", "step", "name"]).select("run_id", "step", "name", "value")


@register("s14_list_checkpoints", sql=f"""{MP.BASE}
SELECT run_id, 'ckpt_step_' || printf('%07d', step) || '.pkl' AS name, step FROM cs
UNION ALL SELECT run_id, 'checkpoint-' || CAST(step AS VARCHAR), step FROM cs""")
def s14_list_checkpoints(spark, sf):
    from tokenloom.operators import metrics

    ev = metrics.checkpoint_names(MP._ckpts(spark, sf), "step")
    path = stage_path(spark, "ckpts")
    files = ev.select("run_id", F.col("pkl_name").alias("name")).unionByName(ev.select("run_id", F.col("dir_name").alias("name")))
    sinks.write_checkpoint_files(files.withColumn("payload", F.lit("1")), path)
    return sinks.list_checkpoints(spark, path, "*.txt").select("run_id", "name", "step")


# --- streaming ------------------------------------------------------------------

def _doc_stream(spark, sf):
    """The documents as a stream.  The table is one file or a folder of files:
    named by a glob that only it matches, either can be the source."""
    return prepare.stream_corpus(spark, f"{sf.rstrip('/')}/documents.parque[t]", table(spark, sf, "documents").schema)


@register("s4_stream_corpus", sql="SELECT doc_id, md5(text) AS text_md5, length(text) AS n_chars FROM documents")
def s4_stream_corpus(spark, sf):
    s = _doc_stream(spark, sf)
    out, ck = stage_path(spark, "stream-docs"), stage_path(spark, "stream-docs-ckpt")
    prepare.run_available(s.select("doc_id", "text"), out, ck)
    return spark.read.parquet(out).select(*_out_text())


def _stream_prepared(spark, sf, runs: int = 1, progress: str | None = None):
    s = _doc_stream(spark, sf)
    p = prepare.stream_prepare(s.select("doc_id", "lang", "text"), "doc_id", "text", FL.MIN_CHARS, T.EN_COUNT_DELIM, FL.MIN_MARKS,
                               T.EN_SENTENCE_DELIM, FL.DROP_P, FL.SEED)
    out, ck = stage_path(spark, "stream-prep"), stage_path(spark, "stream-prep-ckpt")
    q = None
    for _ in range(runs):
        q = prepare.run_available(p, out, ck, progress=progress)
    return spark.read.parquet(out), q


@register("st1_stream_prepare", sql=TP.AUG_SQL)
def st1_stream_prepare(spark, sf):
    d, _ = _stream_prepared(spark, sf)
    return d.select(*_out_text())


def _slices(df, key, n):
    """Ranges of ``key`` that make about equal parts, in order; null keys lie in the first."""
    cuts = sorted(set(df.approxQuantile(key, [i / n for i in range(1, n)], 0.01)))
    edges = [None, *cuts, None]
    for lo, hi in zip(edges, edges[1:]):
        low = F.lit(True) if lo is None else F.col(key) >= F.lit(lo)
        high = F.lit(True) if hi is None else F.coalesce(F.col(key) < F.lit(hi), F.lit(True))
        yield df.filter(low & high)


@register("st3_stream_resume", sql=TP.AUG_SQL)
def st3_stream_resume(spark, sf):
    """A run that fails in its third batch (two are committed, one is half
    done), new files, then a second run on the same checkpoint: every record
    once."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    src, out, ck = (stage_path(spark, n) for n in ("resume-src", "resume-out", "resume-ckpt"))
    parts = list(_slices(docs, "doc_id", 4))
    files = []  # files there are after each slice
    for part in parts[:3]:
        part.write.mode("append").parquet(src)
        files.append(len(spark.read.schema(docs.schema).parquet(src).inputFiles()))
    # A batch takes about a slice's files, as many tasks; two batches hold none of the third slice, where the failing record is.
    stream = prepare.stream_corpus(spark, src, docs.schema, max_files_per_trigger=max(1, files[1] // 2))
    bad = parts[2].agg(F.max("doc_id")).first()[0]
    poison = F.when(F.col("doc_id") == F.lit(bad), F.raise_error(F.lit("injected failure")).cast("string")).otherwise(F.col("text"))

    def run(s):
        p = prepare.stream_prepare(s, "doc_id", "text", FL.MIN_CHARS, T.EN_COUNT_DELIM, FL.MIN_MARKS, T.EN_SENTENCE_DELIM, FL.DROP_P, FL.SEED)
        return prepare.run_available(p, out, ck)

    failed = False
    try:
        run(stream.withColumn("text", poison))
    except StreamingQueryException:
        failed = True
    if bad is not None and not failed:
        raise RuntimeError("the injected failure did not stop the first run")
    parts[3].write.mode("append").parquet(src)
    run(stream)
    return spark.read.parquet(out).select(*_out_text())


@register("st4_stream_progress")
def st4_stream_progress(spark, sf):
    path = stage_path(spark, "stream-progress")
    _stream_prepared(spark, sf, progress=path)
    return spark.read.parquet(path)


@register("st2_stream_chunks", sql=TP.CHUNK_SQL + " SELECT chunk_id, md5(text) AS text_md5, length(text) AS n_chars, n_records, is_full FROM chunks")
def st2_stream_chunks(spark, sf):
    """A7 on a stream: three deliveries of files, each a run on the same
    checkpoint; chunks of 1,000 source records run on from one to the next."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    src, out, ck = (stage_path(spark, n) for n in ("chunk-src", "stream-chunks", "stream-chunks-ckpt"))
    for part in _slices(docs, "doc_id", 3):
        part.write.mode("append").parquet(src)
        s = prepare.stream_corpus(spark, src, docs.schema)
        p = augment.prepare_documents(s, "doc_id", "text", FL.MIN_CHARS, T.EN_COUNT_DELIM, FL.MIN_MARKS, T.EN_SENTENCE_DELIM, TP.P, TP.SEED, flag="passed")
        prepare.stream_chunks(p, out, ck, "doc_id", "text", "passed", TP.CHUNK)
    c = prepare.stream_chunk_texts(spark.read.parquet(f"{out}/rows"), TP.CHUNK, " ")
    return c.select("chunk_id", F.md5("text").alias("text_md5"), T.char_len("text").alias("n_chars"), "n_records", "is_full")


@register("st5_stream_early_stop", sql=f"{MP.BASE} SELECT run_id, step, best_before, improved, patience_after, patience_after >= {MP.PATIENCE} AND coalesce(max(CASE WHEN patience_after >= {MP.PATIENCE} THEN 1 END) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS stop FROM pt")
def st5_stream_early_stop(spark, sf):
    """Three deliveries of evaluations in step order, each of as many files as
    it has tasks; runs are scanned in segments."""
    e = MP.evals(spark, sf).select("run_id", "step", "eval_idx", "loss")
    src, out, ck = (stage_path(spark, n) for n in ("eval-stream", "early-stop", "early-stop-ckpt"))
    for part in _slices(e, "eval_idx", 3):
        part.write.mode("append").parquet(src)
        early_stop.run_early_stop(prepare.stream_corpus(spark, src, e.schema), out, ck, MP.PATIENCE)
    return spark.read.parquet(f"{out}/rows").select("run_id", "step", "best_before", "improved", "patience_after", "stop")


# --- BPE and generation -------------------------------------------------------------

BPE_VOCAB = 2_048
_TOKENIZERS: dict = {}


def _bpe(spark, sf, pretokenize="whitespace"):
    """Tokenizer of all documents, trained once for the queries of a session."""
    at = (spark.sparkContext.applicationId, sf, pretokenize)
    if at not in _TOKENIZERS:
        docs = table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        vocab, merges = bpe.train_bpe(docs, "text", BPE_VOCAB, pretokenize=pretokenize)
        _TOKENIZERS[at] = cut_lineage(vocab, "bpe-vocab"), cut_lineage(merges, "bpe-merges")
    return _TOKENIZERS[at]


def _encoded(spark, sf, pretokenize):
    vocab, merges = _bpe(spark, sf, pretokenize)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    enc = bpe.encode_bpe(docs, vocab, merges, "doc_id", "text", pretokenize)
    return enc.select("doc_id", F.size("ids").alias("n_ids"), A.ints_md5("ids").alias("ids_md5"))


@register("t1_train_bpe")
def t1_train_bpe(spark, sf):
    return _bpe(spark, sf)[1]


@register("t1_train_bpe_lines")
def t1_train_bpe_lines(spark, sf):
    """No pre-tokenizer: merges run over whole lines, spaces included."""
    return _bpe(spark, sf, "none")[1]


@register("t4_encode_bpe")
def t4_encode_bpe(spark, sf):
    return _encoded(spark, sf, "whitespace")


@register("t4_encode_bpe_lines")
def t4_encode_bpe_lines(spark, sf):
    return _encoded(spark, sf, "none")


@register("m5_generate")
def m5_generate(spark, sf):
    """Continue every benchmark item (context cut to 64 tokens) by 8
    tokens with the count model of all training streams."""
    blocks, v = FL.lm_blocks(spark, sf, lookahead=1)
    bounds = splits.split_ratio(splits.stream_lengths(blocks, FL.STREAMS, FL.BLOCK), FL.VAL_RATIO, FL.STREAMS)
    pairs = ngram.pairs_in_split(ngram.block_pairs(blocks, FL.BLOCK, FL.STREAMS), bounds, "train", FL.STREAMS)
    model = cut_lineage(ngram.fit_next_token(pairs.drop("lang")), "model")
    bench = table(spark, sf, "benchmark").select(F.col("item_id").alias("prompt_id"), "text")
    prompts = tokenizer.encode(bench, v, "prompt_id", "text", carry=[]).filter(F.size("ids") > 0)
    out = generate.generate(prompts, model, v, n_new=8, seed=FL.SEED, block=FL.BLOCK)
    return out.select("prompt_id", "n_added", A.ints_md5("ids").alias("ids_md5"))
