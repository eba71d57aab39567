"""Phrase collocations from sorted count streams.

Phrases of up to five words are counted in three passes.  Each task counts the
windows of its documents on word ids and sends one partial count per phrase;
the partial counts are partitioned and sorted in prefix order, and equal
neighbours of the sorted streams are summed.  A phrase can only be frequent if
its words and word pairs are: the first pass counts words; the second pairs of
frequent words, as 64-bit numbers (two pairs that share one only add to each
other's count); the third looks at chains of such pairs alone and counts all
phrases of two words and more by their words.  This reduction is exact.  Tasks
know the frequent words and pairs by a bitmap of ``filter_bits`` bits, whatever
the corpus (2 MB by default): what passes it in vain is counted and falls out
in the last merge, and nothing frequent is ever missed.

The frequent phrases are one count stream.  Every cut of a candidate is
merge-joined with it twice: sorted by the part before the cut (prefix order,
left counts) and by the part behind it (suffix order, right counts).  The
greatest count of a phrase's one-word extensions, from the same stream in
either order, tells whether a longer phrase covers it; of extensions by more
words none can be more frequent than the one-word extension inside.

Null text is empty, null lang is ``und``; doc_id is not read, so repeated rows
and null ids count like others; extra columns are ignored; an empty table gives
an empty result.  Texts are read whole, in chunks: a very long text, or a very
long piece of one, carries its last words over to the next chunk.  Ties in
rank go by score, count, then phrase (byte order).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import LOWER, UPPER, Bits, bitmap, mix64
from tokenloom.session import cut_lineage

CHUNK_BYTES = 1 << 22  # text looked at together
MOST_WORDS = 1 << 19  # distinct words a task remembers
MOST_WINDOWS = 1 << 21  # windows counted together
PARTIAL = "lang string, phrase string, m int, c long"
#: Characters that end a piece become LF; tab separates words as a space does.
_TABLE = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def chunks(texts) -> Iterator[tuple[bytes, bool]]:
    """Normalised text in chunks, and whether a chunk goes on in the piece
    that the one before it left off (cut between two words)."""
    held, size = [], 0
    for text in texts:
        raw = text.encode("utf-8", "replace").lower().translate(_TABLE)
        if size and size + len(raw) > CHUNK_BYTES:
            yield b"\n".join(held), False
            held, size = [], 0
        goes_on = False
        while len(raw) > CHUNK_BYTES:
            cut = max(raw.rfind(b"\n", 0, CHUNK_BYTES), raw.rfind(b" ", 0, CHUNK_BYTES))
            if cut < 0:  # one word that fills the chunk
                after = [x for x in (raw.find(b"\n", CHUNK_BYTES), raw.find(b" ", CHUNK_BYTES)) if x >= 0]
                if not after:
                    break
                cut = min(after)
            yield raw[:cut], goes_on
            goes_on = raw[cut : cut + 1] == b" "
            raw = raw[cut + 1 :]
        if goes_on:
            yield raw, True
        else:
            held.append(raw)
            size += len(raw) + 1
    if held:
        yield b"\n".join(held), False


def word_hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * _STEP + b)


class Counter:
    """Counts windows of one language: ids of words, partial counts by order."""

    def __init__(self, lang: str, orders: tuple[int, ...], frequent: Bits | None, pairs: Bits | None, as_hashes: bool = False):
        self.lang, self.orders, self.frequent, self.pairs, self.as_hashes = lang, orders, frequent, pairs, as_hashes
        self.seed = xxhash.xxh64_intdigest(lang.encode())
        self.reset()

    def reset(self) -> None:
        self.ids: dict[bytes, int] = {b"": -2, b"\n": -1}
        self.words: list[bytes] = []
        self.hashes: list[int] = []
        self.windows: dict[int, list[np.ndarray]] = {m: [] for m in self.orders}
        self.held, self.tokens = 0, 0
        self.tail: list[bytes] = []

    def _learn(self, new: list[bytes]) -> None:
        """Ids for words not seen before; a word that is too rare breaks windows as an end of piece does."""
        hashes = [xxhash.xxh64_intdigest(w, self.seed) for w in new]
        common = self.frequent.has(np.array(hashes, np.uint64)).tolist() if self.frequent is not None else [True] * len(new)
        for word, h, ok in zip(new, hashes, common):
            if ok:
                self.ids[word] = len(self.words)
                self.words.append(word)
                self.hashes.append(h)
            else:
                self.ids[word] = -1

    def feed(self, chunk: bytes, goes_on: bool) -> None:
        tokens = chunk.replace(b"\n", b" \n ").split(b" ")
        if not goes_on:
            self.tail = []
        ids = self.ids
        self._learn(list(set(tokens).union(self.tail).difference(ids)))
        t = np.fromiter(map(ids.__getitem__, tokens), np.int64, len(tokens))
        before = np.array([ids[w] for w in self.tail], np.int64)
        t = np.concatenate((before, t[t != -2]))
        reach, kept = max(self.orders), []
        last = self.tail if reach > 1 else []
        for w in reversed(tokens):  # the words that the next chunk may go on from
            if len(kept) == reach - 1:
                break
            if w:
                kept.append(w)
        self.tail = [*last, *reversed(kept)][-(reach - 1) :] if reach > 1 else []
        whole = t >= 0
        self.tokens += len(tokens) - tokens.count(b"") - tokens.count(b"\n")
        steps = None
        if self.pairs is not None:
            h = np.array(self.hashes, np.uint64)
            near = np.flatnonzero(whole[:-1] & whole[1:])
            steps = np.zeros(max(len(t) - 1, 0), bool)
            steps[near] = self.pairs.has(pair_hash(h[t[near]], h[t[near + 1]]))
        for m in self.orders:
            n = len(t) - m + 1
            if n <= 0:
                continue
            ok = whole[:n].copy()
            for j in range(1, m):
                ok &= steps[j - 1 : j - 1 + n] if steps is not None else whole[j : j + n]
            ok[: max(0, len(before) - m + 1)] = False  # these lie in the chunk before
            at = np.flatnonzero(ok)
            if len(at):
                self.windows[m].append(np.stack([t[at + j] for j in range(m)]).astype(np.int32))
                self.held += len(at)

    def full(self) -> bool:
        return self.held >= MOST_WINDOWS or len(self.ids) >= MOST_WORDS

    def drain(self) -> Iterator[pd.DataFrame]:
        if self.orders == (1,) and self.tokens:  # all words: the phrase of none
            yield pd.DataFrame({"lang": self.lang, "phrase": "", "m": np.int32(0), "c": [self.tokens]})
        for m, parts in self.windows.items():
            if not parts:
                continue
            w = np.concatenate(parts, axis=1)
            code = w[0].astype(np.int64)
            for j in range(1, m):
                code = np.unique(code * len(self.words) + w[j], return_inverse=True)[1]
            _, first, counts = np.unique(code, return_index=True, return_counts=True)
            rows = w[:, first]
            if self.as_hashes:
                h = np.array(self.hashes, np.uint64)
                yield pd.DataFrame({"h": pair_hash(h[rows[0]], h[rows[1]]).view(np.int64), "c": counts})
                continue
            names = [list(map(self.words.__getitem__, r.tolist())) for r in rows]
            phrases = [b" ".join(p).decode("utf-8") for p in zip(*names)]
            yield pd.DataFrame({"lang": self.lang, "phrase": phrases, "m": np.int32(m), "c": counts})
        tail = self.tail
        self.reset()
        self.tail = tail


def _count(orders: tuple[int, ...], frequent=None, pairs=None, as_hashes: bool = False):
    """mapInPandas over lang, text: partial counts (of the hashes of pairs, if
    asked).  The filters are broadcast variables."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Bits(frequent.value) if frequent is not None else None
        linked = Bits(pairs.value) if pairs is not None else None
        counters: dict[str, Counter] = {}
        for pdf in batches:
            for lang, texts in pdf.groupby("lang", sort=False)["text"]:
                counter = counters.setdefault(lang, Counter(lang, orders, known, linked, as_hashes))
                for chunk, goes_on in chunks(texts):
                    counter.feed(chunk, goes_on)
                    if counter.full():
                        yield from counter.drain()
            if len(counters) > 32 or sum(c.held + len(c.ids) for c in counters.values()) > 2 * MOST_WINDOWS:
                for counter in counters.values():
                    yield from counter.drain()
                counters = {}
        for counter in counters.values():
            yield from counter.drain()

    return run


def _runs(b: pa.RecordBatch, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Where a new key begins in a sorted batch, and the counts summed by key."""
    turn = np.ones(b.num_rows, bool)
    if b.num_rows > 1:
        turn[1:] = False
        for k in keys:
            c = b.column(k)
            turn[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(turn)
    return starts, np.add.reduceat(b.column("c").to_numpy(zero_copy_only=False), starts)


def _sum_equal(keys: list[str], min_count: int):
    """mapInArrow over a stream that is sorted by ``keys``: each key once, with
    its counts summed, if they reach ``min_count`` (rows with m = 0 in any
    case).  The last key of a batch may go on in the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # one row
        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                b = pa.concat_batches([held, b.cast(held.schema)])
            starts, sums = _runs(b, keys)
            summed = b.take(pa.array(starts)).set_column(b.schema.get_field_index("c"), "c", pa.array(sums))
            held = summed.slice(len(starts) - 1)
            yield kept(summed.slice(0, len(starts) - 1))
        if held is not None:
            yield kept(held)

    def kept(b: pa.RecordBatch) -> pa.RecordBatch:
        enough = pc.greater_equal(b.column("c"), min_count)
        if "m" in b.schema.names:
            enough = pc.or_(enough, pc.equal(b.column("m"), 0))
        return b.filter(enough)

    return run


def merged(partial: DataFrame, min_count: int) -> DataFrame:
    """lang, phrase, m, c of the phrases that occur ``min_count`` times or more.

    A phrase comes at most once from each table that a task drains, so a
    frequent one fills no partition."""
    ordered = partial.repartition("phrase", "lang").sortWithinPartitions("phrase", "lang")
    return ordered.mapInArrow(_sum_equal(["phrase", "lang"], min_count), PARTIAL)


def merged_hashes(partial: DataFrame, min_count: int) -> DataFrame:
    """h of the pairs that may occur ``min_count`` times."""
    ordered = partial.repartition("h").sortWithinPartitions("h")
    return ordered.mapInArrow(_sum_equal(["h"], min_count), "h long, c long").select("h")


def _word_hashes(phrases: DataFrame) -> DataFrame:
    """h of one-word phrases, as tasks compute it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            h = [word_hash(g.encode(), w.encode()) for g, w in zip(pdf["lang"], pdf["phrase"])]
            yield pd.DataFrame({"h": np.array(h, np.uint64).view(np.int64)})

    return phrases.select("lang", "phrase").mapInPandas(run, "h long")


def phrase_counts(docs: DataFrame, min_count: int, max_words: int = 5, filter_bits: int = 1 << 24) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, m, f) of all phrases of up to ``max_words`` words that
    occur ``min_count`` times or more, and (lang, n): all words of a language."""
    base = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words = cut_lineage(merged(base.mapInPandas(_count((1,)), PARTIAL), min_count), "phrase-words")
    totals = words.where("m = 0").select("lang", F.col("c").alias("n"))
    out = words.where("m = 1")
    if max_words >= 2:
        known = bitmap(_word_hashes(out), "h", filter_bits)
        pairs = base.mapInPandas(_count((2,), known, as_hashes=True), "h long, c long")
        linked = bitmap(cut_lineage(merged_hashes(pairs, min_count), "phrase-pairs"), "h", filter_bits)
        longer = base.mapInPandas(_count(tuple(range(2, max_words + 1)), known, linked), PARTIAL)
        out = out.unionByName(cut_lineage(merged(longer, min_count), "phrases"))
        known.unpersist()
        linked.unpersist()
    return out.withColumnRenamed("c", "f"), totals


def collocations(
    docs: DataFrame, min_count: int = 100, max_words: int = 5, top: int = 2000, covered_percent: int = 100, filter_bits: int = 1 << 24
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, k: each language's best ``top``
    phrases by floor(1000 * a * n / (l * r)) at their worst cut (after k words),
    without those that a longer phrase covers in ``covered_percent`` of cases."""
    stream, totals = phrase_counts(docs, min_count, max_words, filter_bits)
    words = F.split("phrase", " ")
    candidates = stream.where("m >= 2").withColumn("w", words)

    # Extension counts: a phrase's one-word extensions, right in prefix order, left in suffix order.
    longer = candidates.where("m >= 3")
    right = longer.select("lang", F.expr("array_join(slice(w, 1, m - 1), ' ')").alias("phrase"), "f")
    left = longer.select("lang", F.expr("array_join(slice(w, 2, m - 1), ' ')").alias("phrase"), "f")
    extended = right.unionByName(left).groupBy("lang", "phrase").agg(F.max("f").alias("ext"))
    open_ = (
        candidates.hint("merge")
        .join(extended, ["lang", "phrase"], "left")
        .where(F.col("ext").isNull() | (F.lit(100) * F.col("ext") < F.lit(covered_percent) * F.col("f")))
    )

    cuts = open_.select("lang", "phrase", "w", "m", F.col("f").alias("a"), F.explode(F.expr("sequence(1, m - 1)")).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("first"), F.expr("array_join(slice(w, k + 1, m - k), ' ')").alias("rest")
    )
    counted = cuts.hint("merge").join(stream.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    counted = counted.hint("merge").join(stream.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    exact = "cast({} as decimal(19,0))".format
    score = F.expr(f"(1000 * {exact('a')} * {exact('n')}) div ({exact('l')} * {exact('r')})").alias("score")
    scored = counted.join(totals, "lang").select("lang", "phrase", "a", "n", F.struct(score, "k", "l", "r").alias("cut"))
    worst = scored.groupBy("lang", "phrase", "a", "n").agg(F.min("cut").alias("cut"))
    best = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = worst.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score", F.col("cut.k").cast("long").alias("k"))


ORACLE_SQL = f"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents
),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (
  SELECT lang, m, unnest([array_to_string(ws[i:i + m - 1], ' ') FOR i IN range(1, len(ws) - m + 2)]) AS phrase
  FROM w, range(1, 6) AS r(m) WHERE len(ws) >= m
),
f AS (SELECT lang, phrase, m, string_split(phrase, ' ') AS ws, count(*) AS a FROM g GROUP BY lang, phrase, m HAVING count(*) >= 100),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
x AS (
  SELECT lang, phrase, max(a) AS ext FROM (
    SELECT lang, array_to_string(ws[1:m - 1], ' ') AS phrase, a FROM f WHERE m >= 3
    UNION ALL SELECT lang, array_to_string(ws[2:m], ' '), a FROM f WHERE m >= 3) GROUP BY lang, phrase
),
c AS (SELECT f.*, unnest(range(1, m)) AS k FROM f LEFT JOIN x USING (lang, phrase) WHERE m >= 2 AND (ext IS NULL OR ext < a)),
s AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, t.n,
         ((1000::HUGEINT * c.a * t.n) // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:c.k], ' ')
         JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[c.k + 1:c.m], ' ')
         JOIN t ON t.lang = c.lang
),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score, k
FROM b QUALIFY rank <= 2000
"""
