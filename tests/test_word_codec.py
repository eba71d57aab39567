"""Word-level encode and decode without a row for each word."""

from tokenloom.operators import tokenizer

VOCAB = [("<|endoftext|>", 0, True), ("<pad>", 1, True), ("a", 2, False), ("b", 3, False), ("c", 4, False)]


def _vocab(spark):
    return spark.createDataFrame(VOCAB, tokenizer.VOCAB_SCHEMA)


def test_encode_and_decode_rows(spark):
    rows = [(1, "x", "a b zz c"), (1, "x", "c a"), (2, None, "\u3000b\x1cb\u2028a "), (3, "x", None), (4, "x", "zz"), (None, "x", "a <pad> b")]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    enc = tokenizer.encode(df, _vocab(spark))
    # Rows of one key are merged by the words' positions, then ids.
    assert sorted(((r["doc_id"] or 0, r["lang"], r["ids"]) for r in enc.collect()), key=lambda r: r[0]) == [
        (0, "x", [2, 1, 3]), (1, "x", [2, 4, 2, 3, 4]), (2, None, [3, 3, 2]), (3, "x", []), (4, "x", [])]
    dec = tokenizer.decode(enc, _vocab(spark))
    assert sorted((r["doc_id"] or 0, r["text"]) for r in dec.collect()) == [(0, "a b"), (1, "a c a b c"), (2, "b b a"), (3, ""), (4, "")]
    kept = tokenizer.decode(enc, _vocab(spark), skip_special=False)
    assert ("a <pad> b") in [r["text"] for r in kept.collect()]


def test_no_row_for_each_word(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    enc = tokenizer.encode(df, _vocab(spark))
    for d in (enc, tokenizer.decode(enc, _vocab(spark))):
        assert "Generate" not in d._jdf.queryExecution().executedPlan().toString()
