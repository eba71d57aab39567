"""Periodic runs of words by string synchronising sets.

A run is a maximal stretch of words with smallest period q that is at least
two periods long.  Scale t = 2, 4, 8, ... finds the periods in [3t-1, 6t-1):

* A position is in the scale's set if the least hash among the t-word windows
  that start in [i, i+t] is that of window i or i+t.  Membership depends on
  the 2t words at i alone, so both copies of a period hold the same positions;
  two positions with equal 2t words propose their distance as a period.
* Windows with a period of t/3 or less are left out of the sets (they would
  fill them).  These highly periodic regions are known from smaller scales;
  neighbouring regions of one period propose the periods that align them.

Periods below 5 are found by comparing each word with its neighbours.  Each
proposal is extended both ways on word ids that stand for whole words, so hash
collisions propose in vain but change nothing.

Null or blank text has no words and no runs.  Each row stands alone: repeated
rows, null ids and extra columns (kept in ``row``) change nothing, and an
empty table gives an empty result.  Texts are scanned whole; short ones share
a scan of about ``BATCH_WORDS`` words, a long one has its own, in memory linear
in its words.  Of equally long runs the first is reported, then the one with
the smaller period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import words

BATCH_WORDS = 1 << 16
RUNS = "array<struct<start:long,length:long,period:long>>"
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = x * _B
    x ^= x >> np.uint64(31)
    return x * _A


def _agree(t: np.ndarray, a: int, b: int) -> int:
    """How many words from a and from b on are equal (b > a)."""
    n, step, far = 0, 64, len(t)
    while b + n < far:
        same = t[a + n : min(a + n + step, far - b + a)] == t[b + n : b + n + step]
        if not same.all():
            return n + int(np.argmin(same))
        n += len(same)
        step *= 2
    return n


def _agree_back(t: np.ndarray, a: int, b: int) -> int:
    """How many words before a and before b are equal (b > a)."""
    n, step = 0, 64
    while n < a:
        lo = max(0, a - n - step)
        same = t[lo : a - n] == t[lo + b - a : b - n]
        if not same.all():
            return n + int(np.argmin(same[::-1]))
        n += len(same)
        step *= 2
    return n


def _primitive(t: np.ndarray, s: int, q: int) -> bool:
    """Whether t[s:s+q] is no repetition of a shorter block."""
    rest, f = q, 2
    while rest > 1:
        if f * f > rest:
            f = rest
        if rest % f == 0:
            d = q // f
            if (t[s : s + q - d] == t[s + d : s + q]).all():
                return False
            while rest % f == 0:
                rest //= f
        f += 1
    return True


class Runs:
    """Runs found so far: start, end, period; starts are remembered by period."""

    def __init__(self, t: np.ndarray):
        self.t = t
        self.found: list[tuple[int, int, int]] = []

    def neighbours(self, q: int) -> None:
        """All runs of period q by comparing each word with the q-th next."""
        t = self.t
        if len(t) < 2 * q:
            return
        same = np.concatenate(([False], t[:-q] == t[q:], [False]))
        turn = np.flatnonzero(same[1:] != same[:-1])
        starts, ends = turn[::2], turn[1::2] + q
        for s, e in zip(starts[ends - starts >= 2 * q].tolist(), ends[ends - starts >= 2 * q].tolist()):
            if _primitive(t, s, q):
                self.found.append((s, e, q))

    def propose(self, q: int, at: np.ndarray) -> None:
        """Extend period q around the sorted positions ``at`` (word and q-th
        next word are equal there, if the proposal is right)."""
        t, i = self.t, 0
        while i < len(at):
            p = int(at[i])
            e = p + q + _agree(t, p, p + q)
            if e > p + q:
                s = p - _agree_back(t, p, p + q)
                if e - s >= 2 * q and _primitive(t, s, q):
                    self.found.append((s, e, q))
            i = int(np.searchsorted(at, max(e - q, p + 1)))

    def periodic(self, most: int, length: int) -> list[tuple[int, int, int]]:
        """Runs of period ``most`` or less and of at least ``length`` words, by period and start."""
        return sorted((r for r in self.found if r[2] <= most and r[1] - r[0] >= length), key=lambda r: (r[2], r[0]))

    def aligned_pairs(self, scale: int) -> None:
        """Periods of this scale that align two neighbouring highly periodic regions."""
        t, low, high = self.t, 3 * scale - 1, 6 * scale - 1
        regions = self.periodic(scale // 3, low)
        asked: dict[int, list[int]] = {}
        for (a0, a1, p), (b0, _, p2) in zip(regions, regions[1:]):
            if p != p2 or b0 > a1:
                continue
            block = t[a1 : a1 + p]
            for shift in range(p):
                if (t[a1 - p - shift : a1 - shift] == block).all():
                    q = p + shift
                    q += max(0, -(-(low - q) // p)) * p
                    while q < high and q <= a1 - a0:
                        asked.setdefault(q, []).append(a1 - q)
                        q += p
                    break
        have = {(s, q) for s, _, q in self.found if low <= q < high}
        for q, at in asked.items():
            before = len(self.found)
            self.propose(q, np.unique(at))
            new = [r for r in self.found[before:] if (r[0], q) not in have]
            self.found[before:] = new


def scan(t: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """All runs (start, end, period) of the texts in ``t``: word ids, each text
    ended by an id that occurs once; text d starts at offsets[d]."""
    runs = Runs(t)
    for q in range(1, 5):
        runs.neighbours(q)
    where = np.arange(len(t))  # positions that this scale still looks at
    code = _scramble(t.astype(np.uint64) + np.uint64(1))  # hashes of windows of ``scale`` words
    sizes = np.diff(np.concatenate((offsets, [len(t)])))
    code = _wider(code, 1)
    scale = 2
    while sizes.max(initial=0) - 1 >= 2 * (3 * scale - 1):
        keep = sizes - 1 >= 2 * (3 * scale - 1)
        if sizes[keep].sum() < 0.7 * len(where):  # go on with the longer texts alone
            stay = np.repeat(keep, sizes)
            where, code, sizes = where[stay], code[stay], sizes[keep]
        n = len(where)
        value = code
        regions = np.array(runs.periodic(scale // 3, scale), np.int64).reshape(-1, 3)
        if len(regions):
            starts = np.searchsorted(where, regions[:, 0])
            here = (starts < n) & (where[np.minimum(starts, n - 1)] == regions[:, 0])  # in a text still looked at
            edge = np.zeros(n + 1, np.int32)
            np.add.at(edge, starts[here], 1)
            np.add.at(edge, (starts + regions[:, 1] - regions[:, 0] - scale + 1)[here], -1)
            value = np.where(np.cumsum(edge[:-1]) > 0, _TOP, np.minimum(code, _TOP - np.uint64(1)))
        least, w = value.copy(), 1
        while w < scale:
            least[: n - w] = np.minimum(least[: n - w], least[w:])
            w *= 2
        m = n - scale
        least = np.minimum(least[:m], value[scale:])
        chosen = np.flatnonzero(((value[:m] == least) | (value[scale:] == least)) & (least < _TOP))
        wide = _wider(code, scale)  # 2 * scale words
        context = wide[chosen]
        order = np.argsort(context, kind="stable")
        at, context = chosen[order], context[order]
        low, high, asked = 3 * scale - 1, 6 * scale - 1, []
        for k in range(1, len(at)):
            near = np.flatnonzero((context[k:] == context[:-k]) & (at[k:] - at[:-k] < high))
            if not len(near):
                break
            gap = at[k:][near] - at[:-k][near]
            far = gap >= low
            asked.append(np.stack((gap[far], where[at[:-k][near[far]]])))
        if asked:
            gaps, places = np.concatenate(asked, axis=1)
            by = np.lexsort((places, gaps))
            gaps, places = gaps[by], places[by]
            cuts = np.flatnonzero(np.diff(gaps, prepend=-1))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(gaps)]):
                runs.propose(int(gaps[a]), places[a:b])
        runs.aligned_pairs(scale)
        code, scale = wide, 2 * scale
    return np.array(runs.found, np.int64).reshape(-1, 3)


def _wider(code: np.ndarray, size: int) -> np.ndarray:
    """Hashes of windows of twice ``size`` words."""
    out = code.copy()
    out[: len(code) - size] = _scramble(code[: len(code) - size] * _A + (code[size:] ^ _B))
    return out


def find_runs(texts: list[list[bytes]], min_length: int) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each list of words, by start, then period."""
    sizes = np.array([len(ws) + 1 for ws in texts], np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    ids: dict[bytes, int] = {}
    t = np.empty(int(sizes.sum()), np.int64)
    for o, ws in zip(offsets.tolist(), texts):
        t[o : o + len(ws)] = [ids.setdefault(w, len(ids)) for w in ws]
    t[offsets + sizes - 1] = -1 - np.arange(len(texts))
    found = scan(t, offsets)
    found = found[found[:, 1] - found[:, 0] >= min_length]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    of = np.searchsorted(offsets, found[:, 0], side="right") - 1
    for d, s, e, q in zip(of.tolist(), (found[:, 0] - offsets[of]).tolist(), (found[:, 1] - offsets[of]).tolist(), found[:, 2].tolist()):
        out[d].append((s, e - s, q))
    return out


def collapse(ws: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words that lie in no run behind its first period."""
    if runs:
        edge = np.zeros(len(ws) + 1, np.int64)
        for s, length, q in runs:
            edge[s + q] += 1
            edge[s + length] -= 1
        ws = [w for w, c in zip(ws, np.cumsum(edge).tolist()) if c == 0]
    return b" ".join(ws).decode("utf-8")


def _scanner(min_length: int):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out, part, held = [], [], 0
            for i, text in enumerate(texts):
                part.append(words(text))
                held += len(part[-1])
                if held >= BATCH_WORDS or i + 1 == len(texts):
                    for ws, found in zip(part, find_runs(part, min_length)):
                        out.append((len(ws), [{"start": s, "length": n, "period": q} for s, n, q in found], collapse(ws, found)))
                    part, held = [], 0
            yield pd.DataFrame(out, columns=["n_words", "runs", "collapsed"])

    return F.pandas_udf(run, f"n_words long, runs {RUNS}, collapsed string")


def periodic_runs(docs: DataFrame, min_length: int = 12) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period),
    collapsed (the text without repetitions), row (the input row).

    Runs have at least ``min_length`` words and two periods.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = docs.select(row).select(F.col("row.doc_id").alias("doc_id"), "row", _scanner(min_length)(F.coalesce("row.text", F.lit(""))).alias("found"))
    return found.select("doc_id", "found.*", "row")


def longest(runs):
    """The run of greatest length; ties go to the smaller start, then period."""
    return F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))


def looped(docs: DataFrame) -> DataFrame:
    """``docs`` with the tail of every tenth text (by the crc32 of its id)
    repeating one block: with h the crc and g = h div 10, word i >= a becomes
    word a + (i - a) mod p, where a = g mod n and p = 1 + (n - a) div (3 + g mod 8).
    Texts without an id or words stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    ws = F.expr("filter(split(coalesce(text, ''), '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')")
    some = docs.withColumn("_h", h).withColumn("_w", F.when(F.col("_h") % 10 == 0, ws))
    some = some.withColumn("_g", F.expr("_h div 10")).withColumn("_a", F.when(F.size("_w") > 0, F.col("_g") % F.size("_w")))
    some = some.withColumn("_p", F.expr("1 + (size(_w) - _a) div (3 + _g % 8)"))
    loop = F.expr("array_join(transform(_w, (w, i) -> IF(i < _a, w, _w[int(_a + (i - _a) % _p)])), ' ')")
    return some.withColumn("text", F.when(F.size("_w") > 0, loop).otherwise(F.col("text"))).drop("_h", "_w", "_g", "_a", "_p")


def report(docs: DataFrame, min_length: int = 12) -> DataFrame:
    """Per document: number of runs, the longest one, digests of all runs and of the collapsed text."""
    out = periodic_runs(docs, min_length).withColumn("top", longest("runs"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return out.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
