"""Bucketed scans, packing, splits and window sampling."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tokenloom.operators import ngram, pack, splits
from tokenloom.operators.positions import prefix_sum, row_index, running

B = 4


def test_prefix_sum_skewed_stream_and_sparse_keys(spark):
    rnd = random.Random(1)
    rows = [(("hot" if i % 3 else f"s{i % 5}"), i * 1000 + rnd.randint(0, 9), rnd.randint(0, 9)) for i in range(600)]
    df = spark.createDataFrame(rows, "stream string, k long, n long")
    got = {(r["stream"], r["k"]): r["offset"] for r in prefix_sum(df, "n", ["k"], ["stream"], n_buckets=7).collect()}
    acc = {}
    for s, k, n in sorted(rows, key=lambda r: (r[0], r[1])):
        assert got[(s, k)] == acc.get(s, 0)
        acc[s] = acc.get(s, 0) + n


@settings(max_examples=4, deadline=None)
@given(st.lists(st.floats(allow_nan=False, min_value=-5, max_value=5), min_size=1, max_size=40), st.integers(2, 9))
def test_running_min_independent_of_buckets(spark, vals, nb):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k long, v double").repartition(3)
    got = sorted((r["k"], r["m"]) for r in running(df, "v", "min", ["k"], [], out="m", inclusive=False, n_buckets=nb).collect())
    best = None
    for k, m in got:
        assert m == best
        best = vals[k] if best is None else min(best, vals[k])


def test_row_index_dense(spark):
    df = spark.range(0, 500, 3).withColumnRenamed("id", "k")
    got = sorted((r["k"], r["row_no"]) for r in row_index(df, ["k"], n_buckets=5).collect())
    assert [r for _, r in got] == list(range(len(got)))


def test_null_streams_and_null_keys_are_kept(spark):
    rows = [("a", 1, [1, 2]), (None, 2, [3]), (None, 5, [4, 5, 6]), ("a", None, [7]), ("a", 9, [8, 9])]
    df = spark.createDataFrame(rows, "lang string, k long, ids array<int>")
    got = {(r["lang"], r["k"]): r["offset"] for r in pack.global_offsets(df, "ids", ["k"], ["lang"]).collect()}
    assert got == {("a", None): 0, ("a", 1): 1, ("a", 9): 3, (None, 2): 0, (None, 5): 1}
    blocks = pack.pack_blocks(df, "ids", ["k"], ["lang"], block=2, key_source=df.select("k"))
    assert sorted(((r["lang"] or "", r["block_id"], r["tokens"]) for r in blocks.collect())) == [
        ("", 0, [3, 4]), ("", 1, [5, 6]), ("a", 0, [7, 1]), ("a", 1, [2, 8])]
    numbered = {r["k"]: r["row_no"] for r in row_index(df.select("k"), ["k"], n_buckets=3).collect()}
    assert numbered == {None: 0, 1: 1, 2: 2, 5: 3, 9: 4}


@pytest.mark.parametrize("nb", [2, 5])
def test_text_and_constant_order_keys(spark, nb):
    ids = ["1", "10", "2", "30", "4", "9", "", "é", "zebra-1", "zebra-2"]
    df = spark.createDataFrame([(x,) for x in ids], "k string")
    got = {r["k"]: r["row_no"] for r in row_index(df, ["k"], n_buckets=nb).collect()}
    assert got == {x: i for i, x in enumerate(sorted(ids, key=lambda s: s.encode()))}
    tied = spark.createDataFrame([(7, i) for i in range(20)], "k long, t long")
    assert sorted((r["t"], r["row_no"]) for r in row_index(tied, ["k", "t"], n_buckets=nb).collect()) == [(i, i) for i in range(20)]


def test_concat_batches_is_a_layout(spark):
    df = spark.createDataFrame([(i, list(range(i))) for i in range(7)], "row_no long, input_ids array<int>")
    lay = pack.concat_batches(df, "row_no", "input_ids", rows=2, n_shards=2, n_rows=7)
    got = {r["row_no"]: (r["shard"], r["batch"], r["offset"]) for r in lay.collect()}
    assert got == {0: (0, 0, 0), 1: (0, 0, 0), 2: (0, 1, 0), 3: (0, 1, 2), 4: (1, 0, 0), 5: (1, 0, 4), 6: (1, 1, 0)}


def _lengths_frame(spark):
    # lengths fixture: token arrays of length 0, 1, B-1, B, B+1, 2B
    lens = [0, 1, B - 1, B, B + 1, 2 * B]
    rows, t = [], 0
    for i, n in enumerate(lens):
        rows.append((i, list(range(t, t + n))))
        t += n
    return spark.createDataFrame(rows, "doc_id long, ids array<int>"), t


@pytest.mark.parametrize("lookahead", [0, 1])
def test_pack_blocks_global(spark, lookahead):
    df, n = _lengths_frame(spark)
    blocks = pack.pack_blocks(df, "ids", ["doc_id"], [], B, lookahead=lookahead, materialize=False).orderBy("block_id").collect()
    kept = n - n % B
    assert len(blocks) == kept // B
    for r in blocks:
        start = r["block_id"] * B
        assert list(r["tokens"]) == list(range(start, min(start + B + lookahead, kept)))
    flat = [r["token"] for r in pack.unpack(spark.createDataFrame(blocks), B).orderBy("pos").collect()]
    assert flat == list(range(kept))


def test_pack_per_chunk_and_cap(spark):
    df, n = _lengths_frame(spark)
    per = pack.pack_blocks(df, "ids", ["doc_id"], [], B, policy="per_chunk", materialize=False)
    expect = [x for _, ids in sorted((r["doc_id"], list(r["ids"])) for r in df.collect()) for x in ids[: len(ids) - len(ids) % B]]
    got = [t for r in per.orderBy("block_id").collect() for t in r["tokens"]]
    assert got == expect
    capped = pack.pack_blocks(df, "ids", ["doc_id"], [], B, cap=6, materialize=False)
    assert [t for r in capped.orderBy("block_id").collect() for t in r["tokens"]] == list(range(6))


def test_split_tail_zero_validation(spark):
    """2.16 item 9: n // denom == 0 means no validation rows (not an empty train)."""
    lengths = spark.createDataFrame([(4,)], "n long")
    b = {r["split"]: (r["start"], r["end"]) for r in splits.split_tail(lengths, 5).collect()}
    assert b == {"train": (0, 4), "val": (4, 4)}
    b = {r["split"]: (r["start"], r["end"]) for r in splits.split_ratio(spark.createDataFrame([(103,)], "n long"), 0.2).collect()}
    assert b == {"train": (0, 103 - int(103 * 0.2)), "val": (103 - int(103 * 0.2), 103)}


def test_split_rows_float_rule(spark):
    """2.16 item 10: int(n * (1 - 0.1)) in double arithmetic."""
    for n in (1, 9, 10, 11, 29):
        df = spark.range(n).withColumnRenamed("id", "k")
        got = splits.split_rows(df, 0.1, ["k"]).filter("split = 'train'").count()
        assert got == int(n * (1 - 0.1))


def test_window_draws_exclusive_bound_and_gather(spark):
    """2.16 item 8: starts are in [0, n - B - 1) (the last admissible start is
    never drawn) and each window is the slice of the flat stream."""
    n_tok = 3 * B + 3
    df = spark.createDataFrame([(0, list(range(n_tok)))], "doc_id long, ids array<int>")
    blocks = pack.pack_blocks(df, "ids", ["doc_id"], [], B, materialize=False)
    kept = n_tok - n_tok % B
    bounds = splits.split_ratio(splits.stream_lengths(blocks, [], B), 0.0)
    starts = splits.draw_starts(spark, bounds, "train", steps=20, micro=2, batch=8, block=B, seed=3)
    w = pack.shift_xy(splits.gather_windows(starts, blocks, B), B).collect()
    assert len(w) == 20 * 2 * 8
    for r in w:
        assert 0 <= r["pos"] < kept - B - 1
        assert list(r["tokens"]) == list(range(r["pos"], r["pos"] + B + 1))
        assert list(r["y"]) == list(r["x"])[1:] + [r["pos"] + B]
    with pytest.raises(ValueError):
        splits.require_span(B + 1, B)


def test_cyclic_batches_short_last_no_wrap(spark):
    rows = spark.range(10).withColumnRenamed("id", "row_no")
    got = {}
    for r in splits.cyclic_batches(rows, 10, batch=4, steps=4).collect():
        got.setdefault(r["step"], []).append(r["row_no"])
    assert {k: sorted(v) for k, v in got.items()} == {0: [0, 1, 2, 3], 1: [4, 5, 6, 7], 2: [8, 9], 3: [2, 3, 4, 5]}


def test_block_pairs_respect_split(spark):
    df = spark.createDataFrame([(0, list(range(12)))], "doc_id long, ids array<int>")
    blocks = pack.pack_blocks(df, "ids", ["doc_id"], [], B, lookahead=1, materialize=False)
    bounds = splits.split_ratio(splits.stream_lengths(blocks, [], B), 0.25)  # train [0, 9), val [9, 12)
    pairs = ngram.block_pairs(blocks, B)
    tr = sorted((r["prev"], r["next"]) for r in ngram.pairs_in_split(pairs, bounds, "train").collect())
    va = sorted((r["prev"], r["next"]) for r in ngram.pairs_in_split(pairs, bounds, "val").collect())
    assert tr == [(i, i + 1) for i in range(8)]
    assert va == [(9, 10), (10, 11)]
    model = ngram.fit_next_token(ngram.pairs_in_split(pairs, bounds, "train"))
    ev = ngram.evaluate_model(ngram.pairs_in_split(pairs, bounds, "val"), model, vocab_size=20).first()
    assert ev["n_pairs"] == 2 and abs(ev["cross_entropy"] - 2.995732) < 1e-5  # unseen prev: 1/V
