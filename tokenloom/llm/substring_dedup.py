"""Substring dedup by seed and extend, on words.

Winnowed anchors (the least hash of each window's k-word runs) are seeds.  An
occurrence of an anchor that lies in the corpus twice or more is extended both
ways to its context: all words of the windows that the anchor stands for.
Occurrences meet on their contexts first: all but the earliest of a context are
repeats as a whole.  Where an anchor has several contexts, the earliest
occurrence of each is compared window by window.  Windows that are repeats and
overlap join into maximal repeats.

Tasks know the repeated anchors by a bitmap of ``filter_bits`` bits, whatever the
corpus (what passes in vain meets nobody).  Contexts and windows are told apart
by 64-bit hashes of their words.  Words, anchors and seeds are found over blocks
of many texts at once.

Null text has no words; an empty table gives an empty result; texts of any
length are read whole.  Rows that repeat doc_id and text are one document, and
null ids come before all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import Bits, bitmap, doc_key, id_text, mix64, words
from tokenloom.session import cut_lineage, drop_stage

_BASE = 0x9E3779B97F4A7C15
_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\v\f\r", np.uint8))
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # masks of the first n of 8 bytes
_LONG = 64  # bytes of the longest word that is hashed with the others
_BLOCK = 1 << 20  # bytes of text that are worked on at once
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def span_hashes(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the words from a up to b, for each pair: differences of a running
    polynomial sum, modulo 2^64."""
    if len(_POWERS[0]) <= len(h):
        n = 2 * len(h) + 1
        for i, x in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            step = np.full(n, x, np.uint64)
            step[0] = 1
            _POWERS[i] = np.cumprod(step, dtype=np.uint64)
    up, down = _POWERS
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * up[: len(h)], dtype=np.uint64)))
    return mix64((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of texts that lie one after the other in bytes (text i
    from bounds[i] up to bounds[i + 1]), and the bounds of the texts in words."""
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin, end = bounds[:-1], bounds[1:] - 1
    begin, end = begin[begin < len(data)], end[end >= 0]
    first[begin], last[end] = inside[begin], inside[end]
    starts = np.flatnonzero(first)
    sizes = np.flatnonzero(last) + 1 - starts
    h = sizes.astype(np.uint64) * np.uint64(_BASE)
    eights = np.ndarray(len(data) + 1, "<u8", np.append(data, np.zeros(8, np.uint8)), strides=(1,))  # the 8 bytes from each place on
    which = np.flatnonzero(sizes <= _LONG)
    at, left = starts[which], sizes[which]
    while len(which):
        h[which] = mix64(h[which] ^ (eights[at] & _LOW[np.minimum(left, 8)]))
        more = left > 8
        which, at, left = which[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(sizes > _LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + sizes[i]])
    return h, np.searchsorted(starts, bounds)


def anchors_of(h: np.ndarray, bounds: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window that it stands for and number of its windows of
    each anchor occurrence in texts of word hashes (text i from bounds[i] up to
    bounds[i + 1]); no window reaches over a text's end."""
    n = len(h) - window + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    places = np.arange(len(h) - k + 1)
    grams = span_hashes(h, places, places + k)
    least, at, width = grams, places, 1
    while width <= window - k:  # the first least run of ``width`` places
        step = min(width, window - k + 1 - width)
        less = least[step:] < least[:-step]
        least, at = np.where(less, least[step:], least[:-step]), np.where(less, at[step:], at[:-step])
        width += step
    whole = np.flatnonzero(places[:n] + window <= np.repeat(bounds[1:], np.diff(bounds))[:n])
    at = at[whole]
    cuts = np.flatnonzero(np.diff(at, prepend=-1))
    return grams[at[cuts]].view(np.int64), whole[cuts], np.diff(np.append(cuts, len(whole)))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of about _BLOCK bytes of text (one row at least), the hashes of their
    words, and the bounds of the texts in these."""
    for batch in batches:
        text = batch.column("text").cast(pa.large_binary())
        _, offsets, data = text.buffers()
        if not len(text) or data is None:  # no words at all
            continue
        bounds = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
        data, a = np.frombuffer(data, np.uint8), 0
        while a < len(text):
            b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + _BLOCK, "right")) - 1)
            h, at = word_hashes(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
            yield batch.slice(a, b - a), h, at
            a = b


def _anchors(window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, h, bounds in _blocks(batches):
            anchor, c = np.unique(anchors_of(h, bounds, window, k)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(c)], ["anchor", "c"])

    return run


def _seeds(window: int, k: int, repeated):
    """anchor, context hash, first window, number of windows and their hashes, of
    each occurrence of a known anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Bits(repeated.value)
        for rows, h, bounds in _blocks(batches):
            anchors, starts, sizes = anchors_of(h, bounds, window, k)
            keep = known.has(anchors.view(np.uint64))
            anchors, starts, sizes = anchors[keep], starts[keep], sizes[keep]
            contexts = span_hashes(h, starts, starts + sizes + window - 1).view(np.int64)
            ends = np.append(0, np.cumsum(sizes))
            at = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)
            windows = span_hashes(h, at, at + window).view(np.int64)
            doc = np.searchsorted(bounds, starts, "right") - 1
            own = [rows.column(c).take(pa.array(doc)) for c in ("doc_id", "th")]
            places = [pa.array((starts - bounds[doc]).astype(np.int32)), pa.array(sizes.astype(np.int32))]
            hashes = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(windows))
            yield pa.RecordBatch.from_arrays([*own, pa.array(anchors), pa.array(contexts), *places, hashes], ["doc_id", "th", "anchor", "ctx", "start", "n", "hashes"])

    return run


def cut_text(text: str, starts, sizes, window: int) -> tuple[str, int, int, list[dict]]:
    """Text without the words that the windows cover (``sizes`` windows from
    each of ``starts``), and what was cut."""
    ws = words(text)
    if starts is None or not len(starts):
        return b" ".join(ws).decode("utf-8"), len(ws), 0, []
    s = np.asarray(starts, np.int64)
    order = np.argsort(s)
    s = s[order]
    e = np.maximum.accumulate(s + np.asarray(sizes, np.int64)[order] + window - 1)
    apart = s[1:] > e[:-1]
    begin, end = s[np.append(True, apart)].tolist(), e[np.append(apart, True)].tolist()
    kept = [w for a, b in zip([0, *end], [*begin, len(ws)]) for w in ws[a:b]]
    return b" ".join(kept).decode("utf-8"), len(ws), len(ws) - len(kept), [{"start": a, "end": b} for a, b in zip(begin, end)]


def _cutter(window: int):
    def run(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for text, starts, sizes in parts:
            out = [cut_text(t, s, n, window) for t, s, n in zip(text, starts, sizes)]
            yield pd.DataFrame(out, columns=["text", "n_words", "n_removed", "repeats"])

    return F.pandas_udf(run, "text string, n_words long, n_removed long, repeats array<struct<start:int,end:int>>")


def repeats(base: DataFrame, window: int, k: int, filter_bits: int) -> DataFrame:
    """doc_id, th, starts, sizes: stretches of windows whose words also start earlier."""
    base = base.withColumn("text", F.col("text").cast("binary"))
    counted = base.select("text").mapInArrow(_anchors(window, k), "anchor long, c long").groupBy("anchor").agg(F.sum("c").alias("c"))
    twice = cut_lineage(counted.where("c > 1").select("anchor"), "anchors")
    known = bitmap(twice, "anchor", filter_bits)
    drop_stage(twice)
    kinds = "doc_id long, th long, anchor long, ctx long, start int, n int, hashes array<long>"
    seeds = cut_lineage(base.mapInArrow(_seeds(window, k, known), kinds), "seeds")
    known.unpersist()

    at = F.struct("doc_id", "th", "start")
    contexts = seeds.groupBy("ctx").agg(F.min(at).alias("first"), F.max(at).alias("last"), F.min("anchor").alias("anchor"))
    contexts = cut_lineage(contexts, "contexts")
    again = contexts.where(~F.col("first").eqNullSafe(F.col("last"))).select("ctx", "first")
    later = seeds.select("doc_id", "th", "start", "n", "ctx").join(again, "ctx").where(~at.eqNullSafe(F.col("first")))
    later = cut_lineage(later.select("doc_id", "th", "start", "n"), "later-contexts")

    several = contexts.groupBy("anchor").count().where("count > 1").select("anchor")
    alone = contexts.join(several, "anchor").select("ctx", "first")
    apart = seeds.join(alone, "ctx").where(at.eqNullSafe(F.col("first"))).select("doc_id", "th", "start", F.posexplode("hashes").alias("i", "win"))
    windows = cut_lineage(apart.select("doc_id", "th", (F.col("start") + F.col("i")).alias("start"), "win"), "windows")
    drop_stage(seeds, contexts)
    first = windows.groupBy("win").agg(F.min(at).alias("first"), F.max(at).alias("last"))
    first = first.where(~F.col("first").eqNullSafe(F.col("last"))).select("win", "first")
    single = windows.join(first, "win").where(~at.eqNullSafe(F.col("first"))).select("doc_id", "th", "start", F.lit(1).alias("n"))
    found = later.unionByName(single).groupBy("doc_id", "th").agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("sizes"))
    found = cut_lineage(found, "repeats")
    drop_stage(windows, later)
    return found


def substring_dedup(docs: DataFrame, window: int = 20, k: int = 10, filter_bits: int = 1 << 26) -> DataFrame:
    """doc_id, text (kept words joined by one space), n_words, n_removed,
    repeats (maximal runs of removed words: start, end), row (the input row).

    k: words in an anchor; every repeat of ``window`` words holds one.
    filter_bits: bits that tasks keep of the repeated anchors, a power of two.
    """
    late = repeats(id_text(docs).withColumn("th", doc_key()), window, k, filter_bits)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    b = docs.select(row).select("row", F.col("row.doc_id").cast("long").alias("doc_id"), F.coalesce("row.text", F.lit("")).alias("text"))
    b, x = b.withColumn("th", doc_key()).alias("b"), late.alias("x")
    joined = b.join(x, (F.col("b.th") == F.col("x.th")) & F.col("b.doc_id").eqNullSafe(F.col("x.doc_id")), "left")
    cut = joined.select("b.doc_id", "b.row", _cutter(window)("b.text", "x.starts", "x.sizes").alias("cut"))
    return cut.select("doc_id", "cut.*", "row")
