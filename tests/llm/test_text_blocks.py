"""Substring dedup finds words, anchors and seeds over blocks of texts."""

import random

import numpy as np
import pyarrow as pa

from tokenloom.llm import substring_dedup as sd
from tokenloom.llm.common import words

LONG = "y" * 63


def texts() -> list[str]:
    rnd = random.Random(7)
    vocab = ["a", "b\0", "b", "é", "日本語の長い言葉です", " x", "\x1c", LONG, LONG + "y", LONG + "yy", "12345678", "123456789", "x" * 1000]
    out = ["", " ", "a", "\t a\x0b\x0cb \r\n"]
    for n in (3, 19, 20, 21, 60, 200, 0, 25):
        out.append(rnd.choice(["", " ", "\n"]) + rnd.choice([" ", "\t\n"]).join(rnd.choice(vocab) for _ in range(n)) + rnd.choice(["", " "]))
    return [*out, "", *out]


def batch(some: list[str]) -> pa.RecordBatch:
    ids = pa.array([None if i == 5 else 2**60 + i for i in range(len(some))], pa.int64())
    return pa.RecordBatch.from_arrays([ids, pa.array(range(len(some)), pa.int64()), pa.array([t.encode() for t in some], pa.binary())], ["doc_id", "th", "text"])


def test_words_of_blocks(monkeypatch):
    some = texts()
    for size in (1, 300, 1 << 20):
        monkeypatch.setattr(sd, "_BLOCK", size)
        at, hash_of, rows = 0, {}, batch(["cut off", *some]).slice(1)
        for part, h, bounds in sd._blocks(iter([rows])):
            assert len(bounds) == part.num_rows + 1 and (bounds[0], bounds[-1]) == (0, len(h))
            for i, raw in enumerate(part.column("text").to_pylist()):
                own = h[bounds[i] : bounds[i + 1]].tolist()
                ws = words(some[at])
                assert raw.decode() == some[at] and len(own) == len(ws)
                assert all(hash_of.setdefault(w, x) == x for w, x in zip(ws, own))
                at += 1
        assert at == len(some) and len(set(hash_of.values())) == len(hash_of)
    assert sum(len(h) for _, h, _ in sd._blocks(iter([batch([]), batch(["", " "])]))) == 0


def test_anchors_do_not_reach_over_texts(monkeypatch):
    """A text's anchors are those that it has alone, and each of its windows has one."""
    for part, h, bounds in sd._blocks(iter([batch(texts())])):
        anchors, starts, sizes = sd.anchors_of(h, bounds, 20, 10)
        together = list(zip(anchors.tolist(), starts.tolist(), sizes.tolist()))
        alone = []
        for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
            one = [x.tolist() for x in sd.anchors_of(h[a:b], np.array([0, b - a]), 20, 10)]
            assert sum(one[2]) == max(0, b - a - 19)
            alone += [(x, a + s, n) for x, s, n in zip(*one)]
            grams = sd.span_hashes(h[a:b], np.arange(b - a - 9), np.arange(b - a - 9) + 10).view(np.uint64).tolist() if b - a >= 20 else []
            for x, s, n in zip(*one):
                assert all(min(grams[w : w + 11]) == np.uint64(x & (2**64 - 1)) for w in range(s, s + n))
        assert together == alone


def test_work_is_done_for_many_texts_at_once(monkeypatch):
    """It hashed runs of words text by text: 300 calls for 300 texts, three times that for their seeds."""
    calls, real = [], sd.span_hashes

    def counted(*args):
        calls.append(1)
        return real(*args)

    monkeypatch.setattr(sd, "span_hashes", counted)
    rows = batch([" ".join(f"w{(i * j) % 97}" for j in range(40)) for i in range(300)])

    class Known:
        value = np.full(1, 2**64 - 1, np.uint64)

    found = sum(r.num_rows for r in sd._anchors(20, 10)(iter([rows])))
    seeds = pa.Table.from_batches(sd._seeds(20, 10, Known)(iter([rows]))).to_pylist()
    assert found and sum(r["n"] for r in seeds) == 300 * 21
    assert all(len(r["hashes"]) == r["n"] for r in seeds)
    assert {r["doc_id"] for r in seeds} == {None if i == 5 else 2**60 + i for i in range(300)}
    assert len(calls) <= 4


def test_cut_text():
    ws = [f"w{i}" for i in range(60)]
    got = sd.cut_text("\t".join(ws), [30, 5, 0, 24], [2, 1, 1, 1], 6)
    assert got == (" ".join(ws[11:24] + ws[37:]), 60, 24, [{"start": 0, "end": 11}, {"start": 24, "end": 37}])
    assert sd.cut_text(" a  b ", None, None, 6) == ("a b", 2, 0, [])
    assert sd.cut_text("a b c", [0], [1], 3) == ("", 3, 3, [{"start": 0, "end": 3}])
