"""Hidden Markov language model.

States emit word classes: each frequent word is a class, other words fall in
classes by their ending, and a class emits its words by their counts.  Tasks
run scaled forward-backward over their documents; the expected counts of all
partitions are summed into the next model (Baum-Welch).  A text's score is the
exact likelihood of its sequence by the scaled forward recursion.

Texts are split into words once.  A task's documents are cut into blocks of
bounded size; in a block each distinct word has a number, and the documents are
those numbers.  A block's words meet the corpus by word, for their counts over
all training documents, and come back to the block: one row for each word of a
block, not for each word of a document.  Only words above a fixed share of all
tokens, the classes of their own, go to every task.

Null text is empty: one end token.  Rows that repeat doc_id and text each
count in training and score alike.  With no training text all tokens are unknown.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import id_crc, id_text
from tokenloom.session import cut_lineage, drop_stage

END = b"\n"  # no word holds a line break
ENDINGS = 1024
BLOCK_TOKENS, BLOCK_WORDS, BLOCK_DOCS = 2_000_000, 300_000, 50_000  # a block ends with the document that reaches one
BLOCKS = "block long, doc_id long, held_out boolean, seq binary, wid int, ending int, word binary, c long"
ENCODED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, inside double, seq binary"


def ending(word: bytes) -> int:
    """Class of a word that is not frequent: by its last three bytes."""
    return xxhash.xxh32_intdigest(word[-3:]) % ENDINGS


def batches_by_length(seqs: list[np.ndarray], most: int = 300_000):
    """Positions of sequences, longest first, in batches of bounded size."""
    order, at = np.argsort([-len(s) for s in seqs], kind="stable"), 0
    while at < len(order):
        to, total = at, 0
        while to < len(order) and (to == at or total + len(seqs[order[to]]) <= most) and to - at < 1024:
            total += len(seqs[order[to]])
            to += 1
        yield order[at:to]
        at = to


def forward(seqs: list[np.ndarray], start, trans, emit_t, with_logs: bool = True):
    """Scaled forward pass over sequences sorted longest first: time-major
    observations, scaled alphas (a row a state), scales, active counts, log
    likelihoods."""
    lens = np.array([len(s) for s in seqs])
    flat, first = np.concatenate(seqs), np.concatenate(([0], np.cumsum(lens)[:-1]))
    active = len(lens) - np.searchsorted(lens[::-1], np.arange(lens[0]), side="right")
    offs = np.concatenate(([0], np.cumsum(active)))
    obs = np.empty(offs[-1], np.int64)
    alphas, scales = np.empty((len(start), offs[-1])), np.empty(offs[-1])
    emit, step = np.ascontiguousarray(emit_t.T), np.ascontiguousarray(trans.T)
    logs, alpha = np.zeros(len(lens)), None
    for t, a in enumerate(active.tolist()):
        lo, hi = offs[t], offs[t + 1]
        o = obs[lo:hi] = flat[first[:a] + t]
        alpha = emit.take(o, axis=1) * (start[:, None] if t == 0 else step @ alpha[:, :a])
        c = alpha.sum(axis=0)
        alpha /= c
        if with_logs:
            logs[:a] += np.log(c)
        alphas[:, lo:hi], scales[lo:hi] = alpha, c
    return obs, alphas, scales, active, offs, logs


def expected_counts(seqs, start, trans, emit_t):
    """Baum-Welch counts of sequences sorted longest first."""
    obs, alphas, scales, active, offs, _ = forward(seqs, start, trans, emit_t, with_logs=False)
    k, emit = len(start), np.ascontiguousarray(emit_t.T)
    moves, gamma = np.zeros((k, k)), np.empty_like(alphas)
    beta = np.ones((k, active[-1]))
    for t in range(len(active) - 1, -1, -1):
        lo, hi = offs[t], offs[t + 1]
        if beta.shape[1] < hi - lo:  # sequences that end here
            beta = np.concatenate((beta, np.ones((k, hi - lo - beta.shape[1]))), axis=1)
        gamma[:, lo:hi] = alphas[:, lo:hi] * beta
        if t:
            ahead = emit.take(obs[lo:hi], axis=1)
            ahead *= beta
            ahead /= scales[lo:hi]
            prev = alphas[:, offs[t - 1] : offs[t - 1] + hi - lo]
            moves += prev @ ahead.T
            beta = trans @ ahead
    emits = np.stack([np.bincount(obs, weights=gamma[s], minlength=len(emit_t)) for s in range(k)])
    return gamma[:, : active[0]].sum(axis=1), moves * trans, emits


class Model:
    """What every task needs; its size does not depend on the corpus."""

    def __init__(self, own, common, total, distinct, in_class, class_counts, states, seed=1):
        self.own, self.common, self.total, self.distinct, self.in_class = own, common, total, distinct, in_class
        self.classes, rng = ENDINGS + len(own), np.random.default_rng(seed)
        self.prior = (class_counts + 1) / (class_counts + 1).sum()
        self.start = np.full(states, 1 / states)
        self.trans = np.full((states, states), 0.3 / states) + 0.7 * np.eye(states)
        emit = self.prior * (0.5 + rng.random((states, self.classes)))
        self.emit = emit / emit.sum(axis=1, keepdims=True)

    def update(self, starts, moves, emits):
        self.start = (starts + 1) / (starts + 1).sum()
        self.trans = (moves + 1) / (moves + 1).sum(axis=1, keepdims=True)
        emit = emits + 50 * self.prior
        self.emit = emit / emit.sum(axis=1, keepdims=True)


def planes(seq: np.ndarray) -> bytes:
    """32-bit numbers as their first bytes, then their second ones, and so on:
    the high ones are mostly zeros, which any compression drops."""
    return seq.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def numbers(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<i4").ravel()


class Numbers(dict):
    """Each word's number, in order of first occurrence."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents as word numbers, each block's documents (no ``word``)
    before its words with their counts in its training texts (no ``seq``)."""
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    first, at = TaskContext.get().partitionId() << 32, 0
    number, ids, held, seqs, tokens = Numbers(), [], [], [], 0

    def out():
        block, n, v = first + at, len(seqs), len(number)
        learn = [s for s, h in zip(seqs, held) if not h]
        c = np.bincount(np.concatenate(learn), minlength=v) if learn else np.zeros(v, np.int64)
        docs = [pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(map(planes, seqs), pa.binary())]
        rest = [pa.int32(), pa.int32(), pa.binary(), pa.int64()]
        yield pa.record_batch([pa.array(np.full(n, block)), *docs, *(pa.nulls(n, t) for t in rest)], names=names)
        found = [np.arange(v, dtype=np.int32), np.fromiter(map(ending, number), np.int32, v)]
        nulls = [pa.nulls(v, x.type) for x in docs]
        yield pa.record_batch([pa.array(np.full(v, block)), *nulls, *map(pa.array, found), pa.array(list(number), pa.binary()), pa.array(c)], names=names)

    for b in batches:
        for doc_id, raw, h in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), b["held_out"].to_pylist()):
            ws = raw.lower().split()  # bytes: A-Z and the six ASCII spaces alone
            ws.append(END)
            ids.append(doc_id)
            held.append(h)
            seqs.append(np.fromiter(map(number.__getitem__, ws), np.int32, len(ws)))
            tokens += len(ws)
            if tokens >= BLOCK_TOKENS or len(number) >= BLOCK_WORDS or len(seqs) >= BLOCK_DOCS:
                yield from out()
                number, ids, held, seqs, tokens, at = Numbers(), [], [], [], 0, at + 1
    if seqs:
        yield from out()


def _encode(shared):
    def run(docs: pa.Table, entries: pa.Table) -> pa.Table:
        m: Model = shared.value
        wid, own = entries["wid"].to_numpy(), entries["own"].to_pylist()
        classes, c = np.empty(len(wid), np.int32), np.empty(len(wid))
        classes[wid], c[wid] = entries["ending"].to_numpy(), entries["c"].to_numpy()
        base, inside = np.log10((c + 1) / (m.total + m.distinct + 1)), np.log10((c + 1) / (m.in_class[classes] + 1))
        for i, w in zip(wid.tolist(), own):
            if w is not None:
                classes[i], inside[i] = m.own[w], 0.0
        seqs = [numbers(s) for s in docs["seq"].to_pylist()]
        flat, lens = np.concatenate(seqs), np.array([len(s) for s in seqs])
        starts = np.cumsum(lens) - lens  # no sequence is empty
        cols = [docs["doc_id"], docs["held_out"], lens, np.add.reduceat((c > 0).astype(np.int64)[flat], starts),
                np.add.reduceat(base[flat], starts), np.add.reduceat(inside[flat], starts), pa.array([planes(classes[s]) for s in seqs], pa.binary())]
        return pa.table(cols, names=[x.split()[0] for x in ENCODED.split(", ")])

    return run


def _sequences(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [numbers(s) for s in batch["seq"].to_pylist()]


def _expect(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        emit_t, total = np.ascontiguousarray(m.emit.T), None
        for b in batches:
            seqs = _sequences(b)
            for pick in batches_by_length(seqs):
                got = expected_counts([seqs[i] for i in pick], m.start, m.trans, emit_t)
                total = got if total is None else tuple(x + y for x, y in zip(total, got))
        if total is not None:
            flat = np.concatenate([x.ravel() for x in total])
            used = np.flatnonzero(flat)
            yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(flat[used])], names=["i", "x"])

    return run


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        emit_t = np.ascontiguousarray(m.emit.T)
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
        for b in batches:
            seqs = _sequences(b)
            logs = np.zeros(len(seqs))
            for pick in batches_by_length(seqs):
                logs[pick] = forward([seqs[i] for i in pick], m.start, m.trans, emit_t)[-1]
            score = logs / math.log(10) + b["inside"].to_numpy()
            yield pa.record_batch([*(b[n] for n in names), pa.array(score)], names=[*names, "score"])

    return run


def hmm_scores(
    docs: DataFrame, states: int = 8, rounds: int = 4, own_words: int = 8192, broadcast_words: int = 1 << 17, fold: tuple[int, int] = (7, 2)
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose crc32(doc_id) mod fold[0] is fold[1] are held out.  Words with
    at least 1/own_words of all tokens are classes of their own; the end is one
    from 1/broadcast_words of them on.
    """
    spark = docs.sparkSession
    base = id_text(docs).select("doc_id", F.col("text").cast("binary").alias("text"), (id_crc() % fold[0] == fold[1]).alias("held_out"))
    blocks = cut_lineage(base.mapInArrow(_blocks, BLOCKS), "blocks", "zstd")
    entries = blocks.where("word is not null").select("block", "wid", "ending", "word", "c")
    total = entries.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]

    # A block holds a word once: the row of its first block stands for the word.
    same = Window.partitionBy("word")
    found = entries.withColumn("c", F.sum("c").over(same)).withColumn("first", F.col("block") == F.min("block").over(same))
    often = (F.col("c") > 0) & (F.col("c") * own_words >= total)
    own = often | ((F.col("c") > 0) & (F.col("word") == F.lit(END)) & (F.col("c") * broadcast_words >= total))
    found = found.select("block", "wid", "ending", "c", "first", often.alias("often"), F.when(own, F.col("word")).alias("own"))
    found = cut_lineage(found, "found-words", "zstd")
    vocab = found.where("first and c > 0")
    # sum(c) = total, so few words are classes of their own.
    common = {bytes(r["own"]): r["c"] for r in vocab.where("own is not null").select("own", "c").collect()}
    classes = {w: ENDINGS + i for i, w in enumerate(sorted(common))}
    rarer, distinct = F.when(~F.col("often"), F.col("c")), 0
    in_class = np.zeros(ENDINGS)
    counts = np.zeros(ENDINGS + len(classes))
    sizes = vocab.groupBy("ending").agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum(rarer), F.lit(0)).alias("c"), F.count(rarer).alias("rare"))
    for r in sizes.collect():  # ENDINGS rows
        in_class[r["ending"]], counts[r["ending"]] = r["c"] + r["rare"], r["c"]
        distinct += r["v"]
    for w, i in classes.items():
        counts[i] = common[w]
    model = Model(classes, common, total, distinct, in_class, counts, states)
    shared = spark.sparkContext.broadcast(model)

    seqs = blocks.where("seq is not null").select("block", "doc_id", "held_out", "seq")
    pairs = seqs.groupBy("block").cogroup(found.select("block", "wid", "ending", "c", "own").groupBy("block"))
    encoded = cut_lineage(pairs.applyInArrow(_encode(shared), ENCODED), "sequences", "zstd")
    drop_stage(blocks, found)

    learn = encoded.where("not held_out").select("seq")
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(model)
        rows = learn.mapInArrow(_expect(now), "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()  # one row a parameter
        flat = np.zeros(states + states * states + states * model.classes)
        flat[[r["i"] for r in rows]] = [r["x"] for r in rows]
        a, b = states, states + states * states
        model.update(flat[:a], flat[a:b].reshape(states, states), flat[b:].reshape(states, -1))
    final = spark.sparkContext.broadcast(model)

    out = encoded.mapInArrow(_score(final), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
