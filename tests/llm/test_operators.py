"""Corpus operators against brute force and exact round trips."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tokenloom.llm import byte_bpe, exact_dedup, hmm_lm, license_scan, line_dedup, near_dedup, packing, quality, substring_dedup, topk_search
from tokenloom.llm.common import words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, th string, key string, score double"


def sample_texts() -> list[str | None]:
    rnd = random.Random(3)
    vocab = ["w%d" % i for i in range(400)]
    passage = [rnd.choice(vocab) for _ in range(60)]
    out: list[str | None] = []
    for i in range(60):
        ws = [rnd.choice(vocab) for _ in range(rnd.choice([3, 40, 90, 200]))]
        if i % 4 == 0:
            ws[1:1] = passage
        out.append(" ".join(ws) + ("\nShared Line \nsame" if i % 3 == 0 else ""))
    near = out[3] + " one more word"
    return [*out, None, "", "  \n ", out[5], out[5].upper(), near, "x " * 30000, "a"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", None, "clash", "clash", 0.5) for i, t in enumerate(sample_texts())]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, repeated rows, an id with two texts."""
    long = " ".join("v%d" % i for i in range(30))
    rows = [(None, long), (None, None), (1, long), (1, long), (2, "other text"), (2, "b"), (3, None)]
    return spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_topk_matches_brute_force(spark):
    rnd = np.random.default_rng(1)
    vecs = [(i, [float(x) for x in rnd.normal(size=8)]) for i in range(120)] + [(i, [0.5] * 8) for i in range(120, 160)]
    rows = [*vecs, (200, None), (201, [float("nan")] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk_search.topk_search(df, df.where("vec_id % 50 = 0"), k=5, block=2).collect()
    q = {i: np.floor(256 * np.array(v)).astype(int) for i, v in vecs}
    want = set()
    for a in q:
        if a % 50 == 0:
            best = sorted((-int(q[a] @ q[b]), b) for b in q if b != a)[:5]
            want |= {(a, r + 1, b, -s) for r, (s, b) in enumerate(best)}
    assert {tuple(r) for r in got} == want
    few = df.where("vec_id < 3")
    assert topk_search.topk_search(few, few.where("vec_id = 0"), k=5).count() == 2
    assert topk_search.topk_search(df.limit(0), df, k=5).count() == 0


def test_golomb_round_trip():
    rnd = np.random.default_rng(2)
    for n in (1, 5, 1000):
        vals = np.unique(rnd.integers(0, 1 << 50, n))
        rice = int(np.log2((1 << 50) // len(vals)))
        assert (exact_dedup.golomb_decode(exact_dedup.golomb_encode(vals, rice), len(vals), rice) == vals).all()


def test_exact_dedup(docs, odd, none):
    texts = [(t or "").encode().lower() for t in sample_texts()]
    for r in exact_dedup.exact_dedup(docs).collect():
        same = [i for i, t in enumerate(texts) if t == texts[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (max(same), len(same), max(same) == r.doc_id)
        assert r.text_sha256 == hashlib.sha256(texts[r.doc_id]).hexdigest()
    assert sorted(r.group_size for r in exact_dedup.exact_dedup(odd).collect()) == [1, 1, 2, 2, 3, 3, 3]
    assert exact_dedup.exact_dedup(none).count() == 0


def test_line_dedup(docs, odd, none):
    split = {i: (t or "").split("\n") for i, t in enumerate(sample_texts())}
    key = {i: [x.encode().strip(b" \t\n\x0b\x0c\r").lower() for x in ls] for i, ls in split.items()}
    often = {k for ks in key.values() for k in ks if k and sum(k in set(o) for o in key.values()) >= 10}
    assert often
    for r in line_dedup.line_dedup(docs).collect():
        kept = [x for x, k in zip(split[r.doc_id], key[r.doc_id]) if k not in often]
        assert (r.text, r.n_lines, r.n_dropped) == ("\n".join(kept), len(split[r.doc_id]), len(split[r.doc_id]) - len(kept))
    assert line_dedup.line_dedup(odd, min_docs=2).count() == 7
    assert line_dedup.line_dedup(none).count() == 0


def test_substring_dedup(docs, odd, none):
    got, seen = {r.doc_id: r for r in substring_dedup.substring_dedup(docs).collect()}, set()
    for i, t in enumerate(sample_texts()):
        ws = words(t or "")
        gone = set()
        for s in range(len(ws) - 19):
            w = tuple(ws[s : s + 20])
            gone |= set(range(s, s + 20)) if w in seen else set()
            seen.add(w)
        kept = b" ".join(w for j, w in enumerate(ws) if j not in gone).decode()
        assert (got[i].text, got[i].n_words, got[i].n_removed) == (kept, len(ws), len(gone))
    assert substring_dedup.substring_dedup(odd).count() == 7
    assert substring_dedup.substring_dedup(none).count() == 0


def test_near_dedup(docs, odd, none):
    sets = []
    for t in sample_texts():
        ws = words(t or "", lower=True)
        sets.append({tuple(ws[j : j + 4]) for j in range(len(ws) - 3)} if len(ws) >= 4 else ({tuple(ws)} if ws else set()))
    root = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    root[i] = min(root[i], root[j])
    got = near_dedup.near_dedup(docs, shingle=4).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {(i, len(s), root[i], root[i] == i) for i, s in enumerate(sets)}
    assert near_dedup.near_dedup(odd, shingle=4).count() == 7
    assert near_dedup.near_dedup(none, shingle=4).count() == 0


def test_packing(docs, none):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = packing.pack_documents(docs, P.path("word_bpe_49k.json"), end_id=1, max_len=64, special_as_text=True).collect()
    for i, t in enumerate(sample_texts()):
        ids, at = [*tok.encode(t or "", add_special_tokens=False).ids, 1], 0
        for r in sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    used: dict[int, int] = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 64 and sorted(used) == list(range(len(used)))
    assert packing.pack_documents(none, P.path("word_bpe_49k.json"), end_id=1).count() == 0


def test_byte_bpe_matches_library(docs, none):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in byte_bpe.encode_documents(docs, path, P.PATTERN).collect()}
    for i, t in enumerate(sample_texts()):
        assert list(got[i].ids) == enc.encode_ordinary(t or "")
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    c, rnd = byte_bpe.codec(path, P.PATTERN), random.Random(1)
    for _ in range(500):
        t = "".join(rnd.choice("abeinorst \n'1é世") for _ in range(rnd.randint(1, 80)))
        assert list(c.encode(t)) == enc.encode_ordinary(t)
    assert byte_bpe.encode_documents(none, path, P.PATTERN).count() == 0


def test_quality_held_out(spark, none):
    rnd = random.Random(5)
    rows, marks = [], []
    for i in range(400):
        good = i % 4 != 0
        ws = [rnd.choice(["the", "of", "river", "stone", "light"]) for _ in range(40)]
        rows.append((i, ". ".join(ws) if good else " ".join(w.upper() + "!!" for w in ws), None, None, None, None, None, None))
        marks.append((i, int(good)))
    docs, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(marks, "doc_id long, quality int")
    out = quality.score(docs, quality.train(docs, labels)).collect()
    assert all(r.predicted == int(r.doc_id % 4 != 0) for r in out if r.held_out)
    assert quality.score(none, quality.train(none, labels)).count() == 0


def test_forward_is_exact_and_training_helps():
    rnd = np.random.default_rng(1)
    m = hmm_lm.Model({b"\n": 1024}, {b"\n": 1}, 10, 3, np.ones(1024), np.ones(1025), 3)
    seqs = [rnd.integers(0, 4, n) for n in (6, 4, 4, 1)]
    def logp(seq):
        a = m.start * m.emit[:, seq[0]]
        for o in seq[1:]:
            a = (a @ m.trans) * m.emit[:, o]
        return np.log(a.sum())
    before = hmm_lm.forward(seqs, m.start, m.trans, m.emit.T)[-1]
    assert np.allclose(before, [logp(s) for s in seqs])
    starts, moves, emits = hmm_lm.expected_counts(seqs, m.start, m.trans, m.emit.T)
    assert np.isclose(starts.sum(), 4) and np.isclose(moves.sum(), 15 - 4) and np.isclose(emits.sum(), 15)


def test_hmm_counts(docs, odd, none):
    out = hmm_lm.hmm_scores(docs, states=2, rounds=1).collect()
    seen: dict[bytes, int] = {}
    toks = {i: [*words(t or "", lower=True), b"\n"] for i, t in enumerate(sample_texts())}
    for i, ts in toks.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            for w in ts:
                seen[w] = seen.get(w, 0) + 1
    n, v = sum(seen.values()), len(seen)
    for r in out:
        base = sum(np.log10((seen.get(w, 0) + 1) / (n + v + 1)) for w in toks[r.doc_id])
        assert r.base_score == pytest.approx(base) and r.train_tokens == n and r.score < 0
        assert (r.n_tokens, r.n_known) == (len(toks[r.doc_id]), sum(w in seen for w in toks[r.doc_id]))
    assert hmm_lm.hmm_scores(odd, states=2, rounds=1).count() == 7
    assert hmm_lm.hmm_scores(none, states=2, rounds=1).count() == 0


def test_license_scan(spark, none):
    rows = [(0, "Plain prose.\nReleased under the MIT License.\nmore"), (1, "A licence to sing in the river"), (2, None),
            (3, "Licensed under the Apache License, Version 2.0."), (None, "Licensed under CC BY-NC 4.0.")]
    rows += [(i, "prose about the river %d and the stone\nlight of day %d" % (i, i)) for i in range(10, 60)]
    docs = spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in rows], SCHEMA)
    model = license_scan.train(docs)
    got = {(r.doc_id, r.line, r.family) for r in license_scan.license_scan(docs, model).collect()}
    assert got == {(0, 1, "mit"), (3, 0, "apache-2.0"), (None, 0, "cc-by-nc")}
    assert license_scan.license_scan(none, model).count() == 0
