"""BPE over whole lines: training in few passes, encoding many rows at once."""

import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.operators import bpe
from tokenloom.operators.bpe_units import Lines, Segment, apply_merges, pair_code


def test_pieces_equal_cutting_unit_by_unit():
    rng = random.Random(3)
    for _ in range(200):
        k = rng.choice([2, 4, 5000])
        units = [[rng.randrange(k) for _ in range(rng.randrange(0, 14))] for _ in range(rng.randrange(1, 9))]
        counts = [rng.randrange(1, 4) for _ in units]
        pairs = sorted({pair_code(*p) for u in units for p in zip(u, u[1:])} | {pair_code(7000, 1)})
        live = sorted(rng.sample(pairs, rng.randrange(0, len(pairs) + 1)))
        want = Counter()
        for u, c in zip(units, counts):
            cuts = [i + 1 for i, p in enumerate(zip(u, u[1:])) if pair_code(*p) not in live]
            for i, j in zip([0, *cuts], [*cuts, len(u)]):
                if j - i > 1:
                    want[tuple(u[i:j])] += c
        seg = Segment.build(units, counts)
        _, pieces, n = seg.pieces(np.array(live, np.int64))
        assert dict(zip((tuple(np.frombuffer(p, np.int32).tolist()) for p in pieces), n.tolist())) == want
        assert [x.tolist() for x in seg.all_pairs()] == [x.tolist() for x in seg.pair_counts()]


def test_merges_are_taken_back():
    rng = random.Random(4)
    for _ in range(100):
        units = [[rng.randrange(3) for _ in range(rng.randrange(2, 12))] for _ in range(rng.randrange(1, 8))]
        seg = Segment.build(units, [rng.randrange(1, 4) for _ in units])
        steps = [(0, 1, 3), (3, 2, 4), (1, 1, 5), (4, 3, 6)]
        made, often, _ = seg.tried(steps)
        n = rng.randrange(len(steps) + 1)
        tried = bpe._Tried(steps, 3, [(-1 - j, c) for j, c in enumerate(often.tolist())])
        tried.taken = [c for *_, c in steps[:n]]
        back = made.relabelled(tried.fix()) if n < len(steps) else made
        want = [apply_merges(u, {pair_code(a, b): (k, c) for k, (a, b, c) in enumerate(steps[:n])}) for u in units]
        assert [back.unit(i) for i in range(len(back.counts))] == [u for u in want if n == len(steps) or len(u) > 1]


def _text(n, seed=5):
    rnd = random.Random(seed)
    parts = ["th", "e", "in", "on", "er", "an", "an", "at", "Ä", "日本", "zz", "o", "r"]
    words = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(300)]
    return ["\n".join(" ".join(rnd.choices(words, range(300, 0, -1), k=rnd.randint(1, 14))) for _ in range(rnd.randint(0, 9))) for _ in range(n)]


@pytest.mark.parametrize("share", [0.3, 0.05])
def test_training_takes_few_passes(spark, monkeypatch, share):
    """One round of 4 to 64 merges was one pass over the corpus, and replayed all
    merges since the last snapshot: dozens of passes for 400 merges."""
    passes = []
    tried = bpe._tried
    monkeypatch.setattr(bpe, "_tried", lambda *a: passes.append(1) or tried(*a))
    monkeypatch.setattr(bpe, "LIVE", share)
    monkeypatch.setattr(bpe, "FEW_PAIRS", 0)
    texts = _text(300)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    vocab, merges = bpe.train_bpe(df, "text", 330, pretokenize="none")
    assert len(passes) <= (16 if share == 0.3 else 60)
    from tests.test_tokenizer_bpe import _library_vocab

    lines = [x for t in texts for x in t.splitlines(keepends=True)]
    assert [r["token"] for r in vocab.orderBy("id").collect()] == _library_vocab(lines, 330, False)[0]


def test_lines_equal_unit_by_unit_also_where_old_ids_come_back():
    rng = random.Random(6)
    for _ in range(150):
        chars = {c: i for i, c in enumerate("abc\n"[: rng.randrange(1, 5)])}
        ranks, top = {}, 4
        for r in range(rng.randrange(0, 12)):
            new = rng.randrange(top) if rng.random() < 0.2 else top
            ranks[pair_code(rng.randrange(top), rng.randrange(top))] = (r, new)
            top += new == top
        texts = ["".join(rng.choice("abcx\n") for _ in range(rng.randrange(0, 20))) for _ in range(rng.randrange(0, 6))]
        ids, ends = Lines(chars, ranks).encode(texts)
        for k, t in enumerate(texts):
            units = [u + "\n" for u in t.split("\n")[:-1]] + [t.split("\n")[-1]]
            want = [s for u in units for s in apply_merges([chars[c] for c in u if c in chars], ranks)]
            assert ids[ends[k] : ends[k + 1]].tolist() == want


def test_many_rows_are_encoded_at_once():
    """A million characters and 400 merges: unit by unit some 2 seconds or more."""
    texts = _text(3000)
    chars = {c: i for i, c in enumerate(sorted(set("".join(texts))))}
    seg = Segment.of_texts(texts, [1] * len(texts))
    ids = np.zeros(max(map(ord, chars)) + 1, np.int32)
    for c, i in chars.items():
        ids[ord(c)] = i
    new = iter(range(len(chars), 10_000))
    merges = Segment(ids[seg.symbols], seg.starts, seg.counts).most_frequent_merges(1, 400, lambda a, b: (next(new), True))
    ranks = {pair_code(a, b): (k, len(chars) + k) for k, (a, b) in enumerate(merges)}
    lines = Lines(chars, ranks)
    begun = time.process_time()
    out, _ = lines.encode(texts)
    took = time.process_time() - begun
    begun = time.process_time()
    want = [s for t in texts for u in t.splitlines(keepends=True) for s in apply_merges([chars[c] for c in u], ranks)]
    assert took < (time.process_time() - begun) / 2
    assert out.tolist() == want


def test_rows_of_a_repeated_key_and_without_a_key(spark):
    """Rows of one key get the units of all of them in order of their number, rows
    without a key none; an id above 2^53 passes unchanged."""
    big = 2**60 + 1
    rows = [(1, "ab\nab"), (1, "ab\nab"), (None, "ab"), (2, None), (3, ""), (big, "abab\n"), (4, "xyz")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    train = spark.createDataFrame([(0, "ab\nab\nabab\n")], "doc_id long, text string")
    vocab, merges = bpe.train_bpe(train, "text", 7, pretokenize="none")
    token = {r["id"]: r["token"] for r in vocab.collect()}
    for part in (df, df.filter("doc_id > 1 OR doc_id IS NULL")):
        got = bpe.encode_bpe(part, vocab, merges, "doc_id", "text", "none").collect()
        spelled = sorted((r["doc_id"] or -1, "".join(token[i] for i in r["ids"])) for r in got)
        one = [(1, "ab\nab\nabab")] * 2 if part is df else []
        assert spelled == [(-1, ""), *one, (2, ""), (3, ""), (4, ""), (big, "abab\n")]
    assert part.select(F.count("*")).first()[0] == 5
