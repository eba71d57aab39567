"""Runs by synchronising sets against an exhaustive search."""

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tokenloom.llm import periodic_runs as P
from tokenloom.llm.common import words


def brute(ws, min_length=1):
    """Every maximal stretch of period q, unless a smaller period holds on it."""
    out, n = [], len(ws)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            if j - i >= q:
                s, e = i, j + q
                if not any(all(ws[x] == ws[x + d] for x in range(s, e - d)) for d in range(1, q)) and e - s >= min_length:
                    out.append((s, e - s, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def check(texts, min_length=1):
    got = P.find_runs(texts, min_length)
    for ws, runs in zip(texts, got):
        assert runs == brute(ws, min_length), ws


def test_random_and_structured_texts():
    rnd = random.Random(5)
    texts = []
    for _ in range(400):
        k, n = rnd.choice([1, 2, 3, 5, 50]), rnd.choice([0, 1, 7, 30, 120])
        texts.append([b"%d" % rnd.randrange(k) for _ in range(n)])
    for _ in range(300):  # blocks repeated, joined and cut
        ws: list[bytes] = []
        for _ in range(rnd.choice([1, 2, 3, 4])):
            block = [b"%d" % rnd.randrange(rnd.choice([2, 2, 9])) for _ in range(rnd.choice([1, 2, 3, 5, 8, 13]))]
            ws += (block * rnd.choice([1, 2, 3, 10, 14]))[: rnd.choice([4, 11, 25, 60])]
        texts.append(ws * rnd.choice([1, 1, 2, 3]))
    check(texts)
    check(texts, 12)
    for ws in texts[::7]:
        check([ws])


def test_neighbouring_regions_of_one_period():
    """Breaks between long regions of one small period: their periods are found by alignment."""
    for p in (1, 2, 3):
        block = [b"%d" % i for i in range(p)]
        for a in (30, 41, 64):
            for b in (29, 40, 65):
                for cut in range(p):
                    left, right = (block * 70)[:a], (block * 70)[cut : cut + b]
                    check([left + right, left + [b"x"] + right + [b"x"] + left, (left + [b"x"] + right) * 2])


def test_fibonacci_word():
    a, b = b"0", b"01"
    while len(b) < 700:
        a, b = b, b + a
    check([[bytes([c]) for c in b]])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b"]), max_size=60).map(lambda x: x * 2), max_size=4))
def test_squares(texts):
    check(texts)


SCHEMA = "doc_id long, text string, runs string, row string, _h long, found string"


def test_operator_and_report(spark):
    rnd = random.Random(2)
    big = (1 << 53) + 1
    rows = [(i, " ".join("w%d" % rnd.randrange(40) for _ in range(rnd.choice([1, 12, 80, 300])))) for i in range(60)]
    rows += [(None, "z " * 40), (big, "a b\tc\n" * 9), (big + 1, ""), (big + 2, None), (3, rows[3][1]), (5, "other"), (61, "x " * 30000)]
    df = spark.createDataFrame([(i, t, "c", "c", 1, "c") for i, t in rows], SCHEMA).coalesce(1)
    want = []
    for i, t in rows:
        ws, h = words(t or ""), zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and ws:
            g = h // 10
            a = g % len(ws)
            p = 1 + (len(ws) - a) // (3 + g % 8)
            ws = [w if j < a else ws[a + (j - a) % p] for j, w in enumerate(ws)]
        found = [(0, len(ws), 1)] if len(ws) == 30000 else brute(ws, 12)
        gone = {j for s, n, q in found for j in range(s + q, s + n)}
        top = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        text = b" ".join(w for j, w in enumerate(ws) if j not in gone)
        lines = "".join("%d,%d,%d\n" % r for r in found)
        exponent = None if top[1] is None else 1000 * top[1] // top[2]
        want.append((i, len(found), *top, exponent, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text).hexdigest()))
    key = str
    got = [tuple(r) for r in P.report(P.looped(df.select("doc_id", "text"))).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert any(w[1] for w in want[:60])
    out = P.periodic_runs(df)  # columns with clashing names stay in the row
    assert out.columns == ["doc_id", "n_words", "runs", "collapsed", "row"] and out.count() == len(rows)
    assert out.where("row.found <> 'c'").count() == 0
    assert P.report(P.looped(df.limit(0))).count() == 0


def test_long_text_in_one_scan():
    rnd = np.random.default_rng(1)
    block = [b"%d" % x for x in rnd.integers(0, 5000, 7000)]
    ws = block * 3 + [b"end"] * 20
    assert [r for r in P.find_runs([ws], 12)[0] if r[1] > 100] == [(0, 21000, 7000)]
