"""Vocabulary, encode/decode, padding, line groups and BPE training."""

import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import bpe, tokenizer

TINY = ["the cat sat", "the cat ran", "the dog sat"]


def test_vocab_specials_first_and_add_special(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TINY)], "doc_id long, text string")
    v = tokenizer.build_vocab(df, "text", vocab_size=6)
    got = sorted((r["id"], r["token"], r["special"]) for r in v.collect())
    assert got == [(0, "<|endoftext|>", True), (1, "<pad>", True), (2, "the", False), (3, "cat", False), (4, "sat", False), (5, "dog", False)]
    v2 = tokenizer.add_special_token(tokenizer.add_special_token(v, "<pad>"), "<mask>")
    assert v2.count() == 7 and v2.filter("token = '<mask>'").first()["id"] == 6


def test_encode_decode_drop_unknown_and_specials(spark):
    df = spark.createDataFrame([(0, "the cat sat"), (1, "the zebra ran"), (2, "")], "doc_id long, text string")
    v = tokenizer.build_vocab(spark.createDataFrame([(t,) for t in TINY], "text string"), "text", vocab_size=20)
    enc = {r["doc_id"]: list(r["ids"]) for r in tokenizer.encode(df, v, "doc_id", "text").collect()}
    ids = {r["token"]: r["id"] for r in v.collect()}
    assert enc == {0: [ids["the"], ids["cat"], ids["sat"]], 1: [ids["the"], ids["ran"]], 2: []}
    with_eos = spark.createDataFrame([(0, enc[0] + [0, 1])], "doc_id long, ids array<int>")
    assert tokenizer.decode(with_eos, v).first()["text"] == "the cat sat"
    assert list(tokenizer.drop_special(with_eos, v).first()["ids"]) == enc[0]


def test_pad_batch_to_longest_of_batch(spark):
    df = spark.createDataFrame([(0, 0, [5]), (0, 1, [5, 6, 7]), (1, 2, [9])], "batch long, k long, ids array<int>")
    got = {r["k"]: (list(r["ids"]), list(r["attention_mask"])) for r in tokenizer.pad_batch(df, "batch", "ids", pad_id=1).collect()}
    assert got == {0: ([5, 1, 1], [1, 0, 0]), 1: ([5, 6, 7], [1, 1, 1]), 2: ([9], [1])}


def test_line_groups_blank_boundary(spark):
    """2.16 item 5: a blank boundary line does not flush; the group runs on to
    the next non-blank boundary line."""
    lines = ["a", "b", "", "c", "  ", "d", "e", "f", "g"]  # n_lines = 3: boundaries at i = 2, 5, 8
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "line_no long, line string")
    got = [r["text"] for r in tokenizer.line_groups(df, "line_no", "line", 3).orderBy("group_id").collect()]
    expect, buf = [], []
    for i, line in enumerate(lines):
        s = line.strip()
        if not s:
            continue
        buf.append(s)
        if (i + 1) % 3 == 0:
            expect.append(" ".join(buf))
            buf = []
    if buf:
        expect.append(" ".join(buf))
    assert got == expect


def _sequential_bpe(words, n_merges, specials=("<|endoftext|>", "<pad>")):
    """Plain sequential BPE: most frequent pair, ties by smallest ids."""
    counts = Counter(words)
    alphabet = sorted({c for w in counts for c in w})
    tokens = list(specials) + alphabet
    ids = {c: i for i, c in enumerate(tokens)}
    seqs = {w: [ids[c] for c in w] for w in counts}
    merges = []
    for _ in range(n_merges):
        pc = Counter()
        for w, s in seqs.items():
            for a, b in zip(s, s[1:]):
                pc[(a, b)] += counts[w]
        if not pc:
            break
        (a, b), _c = min(pc.items(), key=lambda kv: (-kv[1], kv[0]))
        new = len(tokens)
        tokens.append(tokens[a] + tokens[b])
        merges.append((a, b, new))
        for w, s in seqs.items():
            out, i = [], 0
            while i < len(s):
                if i + 1 < len(s) and s[i] == a and s[i + 1] == b:
                    out.append(new)
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            seqs[w] = out
    return tokens, merges


def test_bpe_equals_sequential_and_encodes(spark):
    corpus = TINY + ["a cat and a dog", "aaaa aa abab"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(corpus)], "doc_id long, text string")
    words = [w for t in corpus for w in t.split()]
    n_alpha = len({c for w in words for c in w})
    vocab, merges = bpe.train_bpe(df, "text", vocab_size=2 + n_alpha + 12)
    tokens, seq = _sequential_bpe(words, 12)
    got = [r["token"] for r in vocab.orderBy("id").collect()]
    assert got == tokens
    assert [(r["left"], r["right"], r["id"]) for r in merges.orderBy("rank").collect()] == seq
    test = spark.createDataFrame([(0, "the cat"), (1, "xyz"), (2, "")], "doc_id long, text string")
    enc = {r["doc_id"]: list(r["ids"]) for r in bpe.encode_bpe(test, vocab, merges, "doc_id", "text").collect()}
    tok = {t: i for i, t in enumerate(tokens)}
    assert enc[1] == [] and enc[2] == []  # unseen characters vanish
    assert "".join(tokens[i] for i in enc[0]) == "thecat" and len(enc[0]) <= 6 and tok.get("the") in enc[0] + [None]


def test_bpe_matches_tokenizers_library(spark):
    try:
        from tokenizers import Tokenizer, models, pre_tokenizers, trainers
    except ImportError:  # pragma: no cover
        return
    corpus = TINY * 3 + ["the cat sat on the mat", "a dog and a cat"]
    n_alpha = len({c for t in corpus for c in t if not c.isspace()})
    size = 2 + n_alpha + 10
    tk = Tokenizer(models.BPE())
    tk.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    tk.train_from_iterator(corpus, trainers.BpeTrainer(vocab_size=size, special_tokens=["<|endoftext|>", "<pad>"], show_progress=False))
    ref = [t for t, _ in sorted(tk.get_vocab().items(), key=lambda kv: kv[1])]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(corpus)], "doc_id long, text string")
    vocab, _ = bpe.train_bpe(df, "text", vocab_size=size)
    assert [r["token"] for r in vocab.orderBy("id").collect()] == ref


def test_tokenizer_save_load(spark, tmp_path):
    df = spark.createDataFrame([(t,) for t in TINY], "text string")
    calls = []

    def build():
        calls.append(1)
        return bpe.train_bpe(df, "text", vocab_size=20)

    p = str(tmp_path / "tok")
    v1, m1 = bpe.load_tokenizer(spark, p, build)
    v2, m2 = bpe.load_tokenizer(spark, p, build)
    assert len(calls) == 1
    assert sorted(map(tuple, v1.collect())) == sorted(map(tuple, v2.collect()))
    assert m1.count() == m2.count() == m2.filter(F.col("rank") >= 0).count()


def test_bpe_greedy_mode_deterministic_and_compresses(spark):
    corpus = TINY * 2 + ["a cat and a dog", "the dog ran to the cat"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(corpus)], "doc_id long, text string")
    n_alpha = len({c for t in corpus for c in t if not c.isspace()})
    v1, m1 = bpe.train_bpe(df, "text", vocab_size=2 + n_alpha + 15, batch="greedy")
    v2, m2 = bpe.train_bpe(df.repartition(3), "text", vocab_size=2 + n_alpha + 15, batch="greedy")
    assert [tuple(r) for r in m1.orderBy("rank").collect()] == [tuple(r) for r in m2.orderBy("rank").collect()]
    assert m1.agg(F.max("round")).first()[0] < 15  # more than one merge per round
    enc = bpe.encode_bpe(df, v1, m1, "doc_id", "text")
    n_ids = enc.select(F.sum(F.size("ids"))).first()[0]
    assert n_ids < sum(len(w) for t in corpus for w in t.split())


def test_doc_line_groups_equal_line_groups(spark):
    docs = [(0, "a\nb\n\nc"), (1, "  \nd\ne"), (2, ""), (3, "f\n\n\ng\nh"), (4, "i")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    lines = [(i, l) for i, l in enumerate(l for _, t in docs for l in t.split("\n"))]
    ref = tokenizer.line_groups(spark.createDataFrame(lines, "line_no long, line string"), "line_no", "line", 3)
    got = tokenizer.doc_line_groups(df, "doc_id", "text", 3)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect()))


def _library_vocab(items, size, whitespace):
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers

    tk = Tokenizer(models.BPE())
    if whitespace:
        tk.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    tk.train_from_iterator(items, trainers.BpeTrainer(vocab_size=size, special_tokens=["<|endoftext|>", "<pad>"], show_progress=False))
    return [t for t, _ in sorted(tk.get_vocab().items(), key=lambda kv: kv[1])], tk


def _lines(n, seed=3):
    rnd = random.Random(seed)
    parts = ["th", "e", "in", "on", "er", "re", "at", "Ä", "ou", "日本", "zz"]
    words = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(150)]
    return [" ".join(rnd.choices(words, range(150, 0, -1), k=rnd.randint(1, 14))) for _ in range(n)]


@pytest.mark.parametrize("pretokenize", ["whitespace", "none"])
def test_incremental_training_equals_the_library(spark, pretokenize):
    """Several snapshots and recounts, a few hundred merges, then the encodings."""
    lines = _lines(400)
    docs = ["\n".join(lines[i : i + 10]) for i in range(0, len(lines), 10)]
    items = docs if pretokenize == "whitespace" else [x + "\n" if j < 9 else x for d in docs for j, x in enumerate(d.split("\n"))]
    size = 420
    want, tk = _library_vocab(items, size, pretokenize == "whitespace")
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    vocab, merges = bpe.train_bpe(df, "text", size, pretokenize=pretokenize, top_pairs=120, snapshot_every=50)
    assert [r["token"] for r in vocab.orderBy("id").collect()] == want
    rounds = merges.agg(F.max("round")).first()[0] + 1
    assert rounds < 0.7 * merges.count()  # several merges a round
    enc = {r["doc_id"]: list(r["ids"]) for r in bpe.encode_bpe(df, vocab, merges, "doc_id", "text", pretokenize).collect()}
    for i, d in enumerate(docs):
        own = [d] if pretokenize == "whitespace" else [x + "\n" if j < 9 else x for j, x in enumerate(d.split("\n"))]
        assert enc[i] == [t for x in own for t in tk.encode(x).ids]


def test_training_until_no_pair_is_left(spark):
    df = spark.createDataFrame([(0, "abcab abcab ab xyz"), (1, None)], "doc_id long, text string")
    vocab, merges = bpe.train_bpe(df, "text", 500, top_pairs=2)
    want, _ = _library_vocab(["abcab abcab ab xyz"], 500, True)
    assert [r["token"] for r in vocab.orderBy("id").collect()] == want
    empty, none = bpe.train_bpe(df.limit(0), "text", 500)
    assert empty.count() == 2 and none.count() == 0


def _sequential_encode(sym, ranks):
    while True:
        found = [(ranks[bpe.pair_code(a, b)], i) for i, (a, b) in enumerate(zip(sym, sym[1:])) if bpe.pair_code(a, b) in ranks]
        if not found:
            return sym
        (_, c), i = min(found)
        sym = [*sym[:i], c, *sym[i + 2 :]]


def test_heap_merges_equal_sequential_merges():
    rnd = random.Random(1)
    for _ in range(300):
        k, ranks, top = rnd.choice([1, 2, 4]), {}, 10
        for r in range(rnd.choice([0, 1, 5, 30])):
            pair = bpe.pair_code(rnd.choice([*range(k), *range(10, top)]), rnd.choice([*range(k), *range(10, top)]))
            if pair not in ranks:
                ranks[pair] = (r, top)
                top += 1
        sym = [rnd.randrange(k) for _ in range(rnd.choice([0, 1, 2, 40]))]
        assert bpe.apply_merges(sym, ranks) == _sequential_encode(list(sym), ranks)


def test_long_line_encodes_quickly():
    """100,000 characters that merge into ever longer tokens."""
    ranks, rnd = {bpe.pair_code(i % 4, (i * 7) % 4): (i, 100 + i) for i in range(16)}, random.Random(2)
    for i in range(16, 400):
        ranks.setdefault(bpe.pair_code(100 + rnd.randrange(i - 15), 100 + rnd.randrange(i - 15)), (i, 100 + i))
    sym = [rnd.randrange(4) for _ in range(100_000)]
    begun = time.perf_counter()
    out = bpe.apply_merges(sym, ranks)
    assert time.perf_counter() - begun < 1.0
    assert len(out) < 90_000
