"""Text functions, filters and sentence augmentation on in-test frames."""

from pyspark.sql import functions as F

from tokenloom.functions import text as T
from tokenloom.functions.keyed import keyed_hash
from tokenloom.operators import augment, filters


def _rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_strip_and_words_follow_python(spark):
    texts = ["　 漢字とかな　", "\x1c a b\x1f", "\t\n plain  text \r\n", "", "   ", "no-space", "a b c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    got = df.select("id", T.strip("t").alias("s"), T.whitespace_words("t").alias("w"), T.has_non_space("t").alias("nb")).orderBy("id")
    for (i, s, w, nb), t in zip(_rows(got, "id", "s", "w", "nb"), texts):
        assert s == t.strip()
        assert list(w) == t.split()
        assert nb == bool(t.strip())


def test_count_literal_and_lengths(spark):
    texts = ["a. b. c.", "。。 。", "ééé", "", "aaaa"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", T.count_literal("t", ".").alias("dot"), T.count_literal("t", "。").alias("ja"),
                    T.count_literal("t", "aa").alias("aa"), T.char_len("t").alias("n"), T.byte_len("t").alias("b")).collect()
    for r in got:
        t = r["t"]
        assert (r["dot"], r["ja"], r["aa"], r["n"], r["b"]) == (t.count("."), t.count("。"), t.count("aa"), len(t), len(t.encode()))


def test_ja_docs_filters_and_script(spark):
    # ja_docs: kana, kanji, Latin only, mixed, U+3000 around; exactly 100/101 chars; 2 and 3 marks
    docs = [
        (1, "　" + "あ" * 98 + "。。。" + "　"),  # 101 after strip, 3 marks
        (2, "カ" * 97 + "。。。"),  # 100 chars: not > 100
        (3, "L" * 99 + "。。"),  # 101 chars, only 2 marks
        (4, "Latin only " * 12),
        (5, "mixed 漢 " + "x" * 100 + "。。。"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    stripped = filters.strip_text(df)
    kept = filters.min_delims(filters.min_length(stripped, "text", 100), "text", "。", 2)
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == [1, 5]
    ja = filters.has_script(df, ["text"]).select("doc_id").collect()
    assert sorted(r[0] for r in ja) == [1, 2, 5]
    absent = filters.has_script(df.select("doc_id"), ["instruction", "context"]).count()
    assert absent == 0


def test_mark_mismatch_drops_whole_documents(spark):
    """2.16 item 1: the filter counts "。" but the split uses "。 "; text without
    the space is one sentence, so dropping it empties the document."""
    text = "文。" * 60  # no "。 " at all
    df = spark.createDataFrame([(i, text) for i in range(200)], "doc_id long, text string")
    out = augment.prepare_documents(df, count_delim="。", delim="。 ", p=0.05, seed=42)
    rows = out.collect()
    assert len(rows) == 200
    assert all(r["text"] in ("", text) for r in rows)
    assert any(r["text"] == "" for r in rows)


def test_older_variant_splits_unstripped_text(spark):
    """2.16 item 2: strip_first=False tests the stripped text but splits the raw one."""
    raw = "  " + "A sentence here. " * 10 + "  "
    df = spark.createDataFrame([(1, raw)], "doc_id long, text string")
    new = augment.prepare_documents(df, p=0.0).first()["text"]
    old = augment.prepare_documents(df, p=0.0, strip_first=False).first()["text"]
    assert sorted(new.split(". ")) == sorted(raw.strip().split(". "))
    assert sorted(old.split(". ")) == sorted(raw.split(". "))


def test_fused_augment_equals_exploded_path(spark):
    docs = [(i, ". ".join(f"s{i}_{j}" for j in range(i % 7 + 1)) + ("." if i % 2 else "")) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    fused = {r["doc_id"]: r["text"] for r in augment.augment_text(df, p=0.3, seed=7).collect()}
    s = augment.split_sentences(df)
    s = augment.drop_random(s, 0.3, 7)
    s = augment.shuffle_within(s, seed=7)
    ex = {r["doc_id"]: r["text"] for r in augment.rejoin(s, df).collect()}
    assert fused == ex
    # the shuffle keeps the multiset of surviving sentences
    for i, t in docs:
        assert sorted(fused[i].split(". ")) == sorted(x for x in fused[i].split(". "))


def test_drop_rule_is_keyed(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(0).alias("pos"))
    kept = augment.drop_random(df, 0.25, 42).count()
    assert 1300 < kept < 1700
    again = augment.drop_random(df.repartition(7), 0.25, 42).count()
    assert kept == again
    h = df.select(keyed_hash(42, "drop", "doc_id", "pos").alias("h")).agg(F.min("h"), F.max("h")).first()
    assert 0 <= h[0] and h[1] < 2**32


def test_corpus_sentences_cross_borders(spark):
    """A2 on border_docs: documents ending in ".", with no delimiter, empty."""
    texts = ["First one. Second", "ends with a dot.", "no delimiter here", "", "x. y. z."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = [r["sent"] for r in augment.corpus_sentences(df).orderBy("sent_id").collect()]
    assert got == " ".join(texts).split(". ")


def test_assemble_chunks_rules(spark):
    """2.16 items 3 and 4: records numbered before filtering; full chunks end
    with a space; an all-filtered full chunk is one space; empty last chunk absent."""
    recs = [(i, f"t{i}", i % 3 != 0 and i not in (3, 4, 5)) for i in range(11)]
    df = spark.createDataFrame(recs, "doc_id long, text string, passed boolean")
    got = [(r["chunk_id"], r["text"], r["is_full"]) for r in augment.assemble_chunks(df, chunk_size=3).orderBy("chunk_id").collect()]
    expect, buf = [], []
    for i, t, ok in recs:
        if ok:
            buf.append(t)
        if (i + 1) % 3 == 0:
            expect.append((i // 3, " ".join(buf) + " ", True))
            buf = []
    if buf:
        expect.append((len(recs) // 3, " ".join(buf), False))
    assert got == expect
    tot = augment.corpus_totals(augment.assemble_chunks(df, chunk_size=3)).first()
    assert tot["total_chars"] == sum(len(t.rstrip(" ")) if f else len(t) for _, t, f in expect)
