"""Line numbers of files, the whole tokenizing job, generation, hot pairs."""

import random

from pyspark.sql import functions as F

from tokenloom.operators import augment, generate, ngram, pack, positions, scores, splits, token_job, tokenizer
from tokenloom.sources import corpus


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_line_numbers_over_splits(spark, tmp_path):
    """Equal to Python's enumerate over files that are read in many splits."""
    rnd = random.Random(2)
    want, whole, total = [], [], 0
    for name in ("b.txt", "a.txt", "c.txt"):
        text = "".join("".join(rnd.choice("ab \t") for _ in range(rnd.randint(0, 30))) + "\n" for _ in range(700)) + "last"
        (tmp_path / name).write_text(text)
    (tmp_path / "d.txt").write_text("")
    for name in ("a.txt", "b.txt", "c.txt"):
        with open(tmp_path / name) as f:
            lines = list(f)
        want += [(name, i, x.strip()) for i, x in enumerate(lines) if x.strip()]
        whole += [(total + i, x.rstrip("\n")) for i, x in enumerate(lines)]
        total += len(lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        d = corpus.scan_text_lines(spark, str(tmp_path))
        got = sorted((r["file"].rsplit("/", 1)[1], r["line_no"], r["line"]) for r in d.collect())
        raw = corpus.scan_text_lines(spark, str(tmp_path), keep_blank=True, whole=True)
        assert sorted((r["line_no"], r["line"]) for r in raw.collect()) == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted(want)


def test_whole_tokenizing_job(spark):
    rnd = random.Random(4)
    docs = [(i, "\n".join(" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 7))) for _ in range(rnd.randint(1, 9)))) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    vocab = tokenizer.build_vocab(df, "text", vocab_size=9)
    ids = {r["token"]: r["id"] for r in vocab.collect()}
    text = "".join(t + "\n" for _, t in docs)
    for n_lines, sample in ((3, 50), (7, 200), (1000, 10**6), (5, 11)):
        part = text[:sample]
        cap = int(sum(w in ids for w in part.split()) * (len(text.encode()) / len(part.encode())))
        cap -= cap % 4
        stream, buf = [], []
        lines = text.split("\n")[:-1]

        def flush(buf):
            enc = [ids[w] for w in " ".join(buf).split() if w in ids]
            enc = enc[: len(enc) - len(enc) % 4]
            return enc[: cap - len(stream)] if len(stream) + len(enc) > cap else enc

        for i, line in enumerate(lines):
            if not line.strip():
                continue
            buf.append(line.strip())
            if (i + 1) % n_lines == 0:
                stream += flush(buf)
                buf = []
        if buf and len(stream) < cap:
            stream += flush(buf)
        blocks = token_job.tokenize_to_blocks(df, vocab, n_lines=n_lines, sample_chars=sample, block=4)
        got = [t for r in blocks.orderBy("block_id").collect() for t in r["tokens"]]
        assert got == stream


def test_positions_move_no_payload(spark):
    """The window's input has keys and sizes, no text or array."""
    df = spark.createDataFrame([(i, f"text {i}", [i] * (i % 5)) for i in range(50)], "doc_id long, text string, ids array<int>")
    d = pack.global_offsets(df, "ids", ["doc_id"])
    for node in _plan(d).split("== Physical Plan ==")[1].split("\n"):
        if "Window" in node or "Exchange" in node:
            assert "text" not in node and "ids" not in node
    at, want = 0, []
    for i in range(50):
        want.append((i, at))
        at += i % 5
    assert sorted((r["doc_id"], r["offset"]) for r in d.collect()) == want
    twice = df.unionByName(df)  # repeated keys: every row keeps a place of its own
    n = positions.row_index(twice, ["doc_id"]).collect()
    assert sorted(r["row_no"] for r in n) == list(range(100)) and all(r["row_no"] // 2 == r["doc_id"] for r in n)


def test_sentences_without_a_delimiter_come_in_pieces(spark):
    texts = ["a. b", "c", "d", "e", "f", "g. h", "i. ", "j"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = augment.corpus_sentences(df, piece_docs=2).orderBy("sent_id", "piece").collect()
    assert max(r["piece"] for r in got) == 2
    joined: dict = {}
    for r in got:
        joined[r["sent_id"]] = joined.get(r["sent_id"], "") + r["sent"]
    assert [joined[i] for i in sorted(joined)] == " ".join(texts).split(". ")
    assert augment.corpus_sentences(df).filter("piece > 0").count() == 0


def test_draws_without_a_cross_join(spark):
    bounds = spark.createDataFrame([("a", "train", 0, 100), ("b", "train", 10, 60), ("c", "train", 0, 3)], "lang string, split string, start long, end long")
    d = splits.draw_starts(spark, bounds, "train", steps=5, micro=2, batch=3, block=8, streams=["lang"], first_step=2)
    assert "NestedLoop" not in _plan(d) and "CartesianProduct" not in _plan(d)
    rows = d.collect()
    assert len(rows) == 2 * 5 * 2 * 3 and {r["step"] for r in rows} == set(range(2, 7))
    assert all((0 <= r["pos"] < 91) if r["lang"] == "a" else (10 <= r["pos"] < 51) for r in rows)


def test_require_span_of_bounds(spark):
    bounds = spark.createDataFrame([("train", 0, 100), ("val", 100, 105)], "split string, start long, end long")
    assert {r["split"]: (r["span"], r["ok"]) for r in splits.require_span(bounds, 8, strict=False).collect()} == {"train": (91, True), "val": (-4, False)}
    try:
        splits.require_span(bounds, 8).collect()
    except Exception as e:
        assert "5 tokens hold no window" in str(e)
    else:
        raise AssertionError("a split without a window passed")


def test_hot_pairs_are_dealt(spark):
    """One pair is half of all: its rows spread over the salts, results are the same."""
    rows = [(d, 1, 2) for d in range(400)] + [(d, d % 7, d % 5) for d in range(400)]
    pairs = spark.createDataFrame(rows, "doc_id long, prev int, next int")
    model = ngram.fit_next_token(pairs.select("prev", "next"))
    counted = pairs.groupBy("doc_id", "prev", "next").count()
    salted, slices = ngram.spread_hot(counted, model.select("prev", "next", "c"), ["prev", "next"])
    hot = [r["count"] for r in salted.filter("prev = 1 and next = 2").groupBy("_salt").count().collect()]
    assert len(hot) > 50 and max(hot) < 3 * sum(hot) / len(hot)
    assert slices.filter("prev = 1 and next = 2").count() == ngram.SALTS
    got = {r["doc_id"]: round(r["nll_sum"], 9) for r in ngram.score_pairs(pairs, model, 50, 1.0, group=["doc_id"]).collect()}
    prob = {(r["prev"], r["next"]): r["p"] for r in ngram.next_token_probs(model, 50).collect()}
    import math

    want: dict = {}
    for d, a, b in rows:
        want[d] = want.get(d, 0) - math.log(prob[a, b])
    assert got == {d: round(x, 9) for d, x in want.items()}


def test_generation_equals_nucleus_and_draw(spark):
    """Each round's tokens are those of M3 and M4 on the last token's candidates."""
    rnd = random.Random(6)
    pairs = spark.createDataFrame([(rnd.randrange(2, 30), int(rnd.triangular(0, 30, 4))) for _ in range(3000)], "prev int, next int")
    model = ngram.fit_next_token(pairs).cache()
    vocab = spark.createDataFrame([(f"w{i}", i, i < 2) for i in range(40)], tokenizer.VOCAB_SCHEMA)
    prompts = spark.createDataFrame([(i, [rnd.randrange(2, 40) for _ in range(3)]) for i in range(40)], "prompt_id long, ids array<int>")
    out = {r["prompt_id"]: (list(r["ids"]), r["n_added"]) for r in generate.generate(prompts, model, vocab, n_new=3, k=6, p=0.8, block=64, seed=5).collect()}
    state = {r["prompt_id"]: list(r["ids"]) for r in prompts.collect()}
    added = dict.fromkeys(state, 0)
    for step in range(3):
        cur = spark.createDataFrame([(i, ids[-1]) for i, ids in state.items()], "prompt_id long, prev int")
        seen = cur.join(model, "prev").select("prompt_id", F.col("next").alias("token"), F.log((F.col("c") + 1) / (F.col("c_prev") + 40)).alias("logit"))
        unseen = cur.join(model.select("prev").distinct(), "prev", "left_anti").select("prompt_id", F.explode(F.sequence(F.lit(2), F.lit(7))).alias("token"))
        kept = scores.nucleus(seen.unionByName(unseen.withColumn("logit", F.lit(0.0))), 6, 0.8, 0.8, group="prompt_id")
        drawn = scores.sample_token(kept.withColumn("_step", F.lit(step)), 5, "prompt_id", draw_keys=["_step"], out="next")
        for r in drawn.collect():
            if r["next"] != 0:
                state[r["prompt_id"]].append(r["next"])
                added[r["prompt_id"]] += 1
    assert out == {i: (state[i], added[i]) for i in state}
    index, _ = generate.candidate_index(model, vocab, k=6, p=0.8)
    assert index.filter(F.size("tokens") > 6).count() == 0
