"""Collocations against direct counting."""

import random
import re
from collections import Counter

import pytest

from tokenloom.llm import collocations as C

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [[w for w in re.split(r"[ \t]+", p) if w] for p in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(ASCII))]


def brute(rows, min_count, top, percent=100, max_words=5):
    out = set()
    for lang in {g or "und" for g, _ in rows}:
        ws = [p for g, t in rows if (g or "und") == lang for p in pieces(t)]
        n = sum(map(len, ws))
        f = Counter(tuple(p[i : i + m]) for p in ws for m in range(1, max_words + 1) for i in range(len(p) - m + 1))
        cand = {p: a for p, a in f.items() if len(p) >= 2 and a >= min_count}
        found = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]], n, score, k))
        out |= {(lang, i + 1, r[2].decode(), *r[3:]) for i, r in enumerate(sorted(found)[:top])}
    return out


def corpus():
    rnd = random.Random(4)
    vocab = ["w%d" % i for i in range(25)] + ["New", "York", "Été", "a b"]
    rows = []
    for i in range(150):
        ws = [rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 5, 60]))]
        text = " ".join(w + rnd.choice(["", "", "", ",", ".", "\n", "\t", " ! "]) for w in ws)
        if i % 3 == 0:
            text += " New York City hall. one two three four five six, one two three four five six"
        rows.append((rnd.choice(["en", "en", "de", None, "und"]), text))
    return [*rows, ("fr", None), ("fr", ""), ("en", rows[0][1]), ("en", "go " * 3000), ("de", "ab cd " * 2000)]


SCHEMA = "lang string, text string, phrase string, m int, f long, w string, n long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(g, t, "clash", 1, 1, "clash", 1) for g, t in corpus()], SCHEMA).repartition(3)


@pytest.mark.parametrize("min_count, top, percent, bits", [(5, 50, 100, 1 << 24), (2, 3000, 60, 64), (20, 4, 100, 1 << 10)])
def test_collocations(docs, min_count, top, percent, bits):
    """A bitmap of 64 bits prunes nothing; the result is the same."""
    got = C.collocations(docs, min_count=min_count, top=top, covered_percent=percent, filter_bits=bits)
    assert {tuple(r) for r in got.collect()} == brute(corpus(), min_count, top, percent)


def test_small_chunks_and_full_tables(spark, docs, monkeypatch):
    """Chunks that cut pieces, and tables that are emptied again and again, lose no window."""
    whole = [(g, t) for g, t in corpus()]
    for size, most_words, most_windows in ((64, 1 << 19, 1 << 21), (7, 8, 16), (1, 3, 1)):
        monkeypatch.setattr(C, "CHUNK_BYTES", size)
        monkeypatch.setattr(C, "MOST_WORDS", most_words)
        monkeypatch.setattr(C, "MOST_WINDOWS", most_windows)
        for orders in ((1,), (2,), (3, 4, 5)):
            want: Counter = Counter()
            got: Counter = Counter()
            for lang in ("en", "de"):
                texts = [t or "" for g, t in whole if g == lang]
                counter = C.Counter(lang, orders, None, None)
                for chunk, goes_on in C.chunks(texts):
                    counter.feed(chunk, goes_on)
                    if counter.full():
                        for pdf in counter.drain():
                            got.update({(lang, p): 0 for p in pdf["phrase"]})
                            for p, c in zip(pdf["phrase"], pdf["c"]):
                                got[lang, p] += c
                for pdf in counter.drain():
                    for p, c in zip(pdf["phrase"], pdf["c"]):
                        got[lang, p] += c
                for t in texts:
                    for ws in pieces(t):
                        if orders == (1,):
                            want[lang, ""] += len(ws)
                        want.update((lang, " ".join(ws[i : i + m])) for m in orders for i in range(len(ws) - m + 1))
            assert got == want


def test_exact_scores_beyond_64_bits(spark):
    a, n, l, r = 10**11, 3 * 10**13, 10**12, 3 * 10**11
    exact = "cast({} as decimal(19,0))".format
    got = spark.sql(f"SELECT (1000 * {exact(a)} * {exact(n)}) div ({exact(l)} * {exact(r)}) AS s").collect()[0].s
    assert got == 1000 * a * n // (l * r)


def test_empty(docs):
    assert C.collocations(docs.limit(0), min_count=1).count() == 0
    assert C.collocations(docs, min_count=10**9).count() == 0
