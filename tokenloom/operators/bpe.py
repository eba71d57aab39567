"""Byte-pair-encoding tokenizer training and encoding (T1, T4/T5 BPE path, S12).

Training works on **distinct units** ``(unit, count)``, so the corpus is read
once (``groupBy(unit).count()``).  Units are white-space words
(``pretokenize="whitespace"``) or whole lines including their newline
(``"none"``, the reference trainer has no pre-tokenizer).

The units lie in segments (``bpe_units.Segment``).  A pair of symbols that comes
less than ``least`` times side by side holds no merge as long as merges of
``least`` places are left: whatever is merged across it comes no more often.  So
units are cut at all such pairs, and sequential training on the few distinct pieces
(always the most frequent pair, ties: smaller ids first) gives the next merges.  One
pass over the segments counts the pieces, a second makes the merges, writes the
segments anew and counts the pairs with one of the new symbols.  Taking a symbol
apart again gives what was there before its merge, so from these counts the driver,
which has the ``top_pairs`` most frequent pairs, knows those after each merge; it
takes a merge only if it is the most frequent pair at its turn, and later ones are
taken back in the next pass.  Pairs that the driver does not keep come later in that
order than all that it keeps, and can only sink; when the kept ones run out, all
pairs are counted anew.

Special tokens get ids ``0..``, then the alphabet in code-point order, then
merged tokens in order; a merge that spells an existing token takes its id.
Characters outside the alphabet vanish on encode.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush, nsmallest

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from tokenloom.functions import text as T
from tokenloom.operators.bpe_units import PAIR_FIELDS, UNIT_FIELDS, Lines, Segment, apply_merges, pair_code, summed
from tokenloom.operators.tokenizer import DEFAULT_SPECIALS, VOCAB_SCHEMA
from tokenloom.session import cut_lineage, drop_stage, stage_path

SEGMENT_SYMBOLS = 1 << 22  # symbols that a segment holds at first, about
MOST_STEPS = 64  # merges that a round tries
MOST_TRIED = 1024  # merges that a pass over the segments makes
MOST_PIECES = 1 << 19  # distinct pieces that come to the driver
ENCODED_SYMBOLS = 1 << 22  # symbols that are merged at once on encode
LIVE = 0.3  # share of all pairs at which units are not cut
FEW_PAIRS = 1 << 16  # where units need not be cut

MERGES_SCHEMA = Ty.StructType(
    [
        Ty.StructField("rank", Ty.IntegerType(), False),
        Ty.StructField("left", Ty.IntegerType(), False),
        Ty.StructField("right", Ty.IntegerType(), False),
        Ty.StructField("id", Ty.IntegerType(), False),
        Ty.StructField("round", Ty.IntegerType(), False),
    ]
)


def _unit_list(col, pretokenize: str) -> F.Column:
    if pretokenize == "whitespace":
        return T.whitespace_words(col)
    if pretokenize == "none":
        return F.regexp_extract_all(F.col(col), F.lit("[^\\n]*\\n|[^\\n]+\\z"), F.lit(0))
    raise ValueError(f"unknown pretokenize {pretokenize!r}")


def units(df: DataFrame, col: str = "text", pretokenize: str = "whitespace") -> DataFrame:
    """Distinct training units with counts."""
    u = df.select(F.explode(_unit_list(col, pretokenize)).alias("unit"))
    return u.groupBy("unit").agg(F.count(F.lit(1)).alias("count"))


def _segments(st: DataFrame) -> tuple[DataFrame, list[str]]:
    """Distinct units as segments of about ``SEGMENT_SYMBOLS`` code points (a
    stage table), and their alphabet in order."""
    size = st.agg(F.coalesce(F.sum(F.length("unit")), F.lit(0)).alias("s"), F.count(F.lit(1)).alias("n")).first()
    spread = min(st.sparkSession.sparkContext.defaultParallelism, size["n"] // 500 + 1)
    n = max(spread, -(-size["s"] // SEGMENT_SYMBOLS))

    def build(key, pdf: pd.DataFrame) -> pd.DataFrame:
        seg = Segment.of_texts(pdf["unit"].tolist(), pdf["count"].tolist())
        return pd.DataFrame([(key[0], *seg.units_row(), sorted(set().union(*pdf["unit"])))], columns=[*_columns(UNIT_FIELDS), "alphabet"])

    keyed = st.withColumn("seg", F.pmod(F.xxhash64("unit"), F.lit(n)))
    out = _stage(keyed.groupBy("seg").applyInPandas(build, f"{UNIT_FIELDS}, alphabet array<string>"))
    alphabet = [r["ch"] for r in out.select(F.explode("alphabet").alias("ch")).distinct().orderBy("ch").collect()]
    return out, alphabet


def _stage(segments: DataFrame) -> DataFrame:
    """A stage table of two segments a file, so that a task reads few."""
    path = stage_path(segments.sparkSession, "bpe-segments")
    segments.write.option("maxRecordsPerFile", 2).option("parquet.enable.dictionary", "false").parquet(path, compression="zstd")
    return segments.sparkSession.read.schema(segments.schema).parquet(path)


def _columns(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _pass(segments: DataFrame, change: Callable[[Segment], tuple[Segment, np.ndarray, np.ndarray]]) -> tuple[DataFrame, DataFrame]:
    """The changed segments as a stage table, and the pair counts (codes, sums)
    that ``change`` gave with them, summed over all segments.  A task adds up
    those of its segments and keeps them in a row of its own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            for row in b.itertuples():
                seg, *pairs = change(Segment.of_units_row(row.symbols, row.starts, row.counts))
                counts.append(tuple(pairs))
                if len(counts) > 8:
                    counts = [summed(*map(np.concatenate, zip(*counts)))]
                yield pd.DataFrame([(row.seg, *seg.units_row(), None, None)], columns=_columns(f"{UNIT_FIELDS}, {PAIR_FIELDS}"))
        if counts:
            codes, sums = summed(*map(np.concatenate, zip(*counts)))
            yield pd.DataFrame([(-1, None, None, None, codes.tobytes(), sums.tobytes())], columns=_columns(f"{UNIT_FIELDS}, {PAIR_FIELDS}"))

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples():
                yield pd.DataFrame({"code": np.frombuffer(row.codes, np.int64), "c": np.frombuffer(row.sums, np.int64)})

    names = _columns(UNIT_FIELDS)
    out = _stage(segments.select(*names).mapInPandas(run, f"{UNIT_FIELDS}, {PAIR_FIELDS}"))
    drop_stage(segments)
    counted = out.filter(F.col("seg") < 0).select(*_columns(PAIR_FIELDS)).mapInPandas(pairs, "code long, c long")
    return out.filter(F.col("seg") >= 0).select(*names), counted.groupBy("code").agg(F.sum("c").alias("c"))


def _recounted(segments: DataFrame, most: int, before: Callable[[Segment], Segment]) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The segments after ``before``, and the ``most`` most frequent pairs:
    (code, count), in order."""

    def change(seg: Segment) -> tuple:
        seg = before(seg)
        return seg, *seg.all_pairs()

    out, counted = _pass(segments, change)
    top = counted.orderBy(F.col("c").desc(), "code").limit(most).collect()
    return out, [(r["code"], r["c"]) for r in top]


def _pieces(segments: DataFrame, fix, live: list[int]) -> DataFrame:
    """Distinct pieces of the units, cut at all pairs but ``live``, with counts."""
    live = np.array(sorted(live), np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts: dict[int, bytes] = {}
        counts: dict[int, int] = {}
        for b in batches:
            for row in b.itertuples():
                seg = Segment.of_units_row(row.symbols, row.starts, row.counts)
                hashes, found, n = (seg.relabelled(fix) if fix else seg).pieces(live)
                for h, text, c in zip(hashes.tolist(), found, n.tolist()):
                    texts.setdefault(h, text)
                    counts[h] = counts.get(h, 0) + c
                if len(texts) > MOST_PIECES:
                    yield pd.DataFrame({"piece": list(texts.values()), "c": list(counts.values())})
                    texts, counts = {}, {}
        yield pd.DataFrame({"piece": list(texts.values()), "c": list(counts.values())})

    return segments.mapInPandas(run, "piece binary, c long").groupBy("piece").agg(F.sum("c").alias("c"))


def _next_merges(segments: DataFrame, fix, table: _PairTable, most: int, live: float, name) -> tuple[list[tuple[int, int]], float]:
    """The next merges of sequential training, and the share of pairs at which
    units were not cut: less than ``live`` where there were too many pieces."""
    pairs = nsmallest(MOST_TRIED, ((-c, k) for k, c in table.counts.items() if table.last is None or (-c, k) <= table.last))
    whole = sum(table.counts.values())
    while True:
        held, least = 0, 0
        for n, _ in pairs:
            if least and held - n > live * whole and whole > FEW_PAIRS:
                break
            held, least = held - n, -n
        found = [k for n, k in pairs if -n >= least]
        pieces = _pieces(segments, fix, found).limit(MOST_PIECES + 1).toArrow()
        if len(pieces) <= MOST_PIECES or len(found) == 1:
            break
        live /= 2
    out = Segment.of_pieces(pieces["piece"].to_pylist(), pieces["c"].to_pylist()).most_frequent_merges(least, most, name)
    best = (table.best() >> 32, table.best() & 0xFFFFFFFF)
    return out if out[:1] == [best] else [best], live


class _Tried:
    """Merges made by a pass one after the other, with ids from ``first`` on, and
    the counts of pairs of their symbols after the last.  Driver side: at most two
    rows for each new symbol and symbol beside it."""

    def __init__(self, steps: list[tuple[int, int, int]], first: int, rows):
        self.steps, self.first = steps, first
        self.made = [0] * len(steps)
        self.taken: list[int] = []  # the ids of merges that were taken
        self.tail, self.head = {}, {}  # a new symbol -> the last and first of those that stand for it now
        self.ends, self.begins = {}, {}  # symbol -> merges that it ends or begins
        self.after, self.before = {}, {}  # new symbol -> what stands behind and before it
        for code, n in rows:
            if code < 0:
                self.made[-1 - code] = n
            else:
                self._beside(code >> 32, code & 0xFFFFFFFF, n)
        for j, (a, b, c) in enumerate(steps):
            self.head[c], self.tail[c] = self.head.get(a, a), self.tail.get(b, b)
            self.begins.setdefault(a, []).append(j)
            self.ends.setdefault(b, []).append(j)
            self._beside(a, b, self.made[j])

    def _beside(self, x: int, y: int, n: int) -> None:
        if x >= self.first:
            self.after.setdefault(x, []).append((y, n))
        if y >= self.first:
            self.before.setdefault(y, []).append((x, n))

    def _chain(self, c: int, by: dict[int, list[int]]) -> list[int]:
        out = [c]
        for s in out:
            out.extend(self.steps[j][2] for j in by.get(s, ()))
        return out

    def next(self) -> int | None:
        """The pair that is merged next."""
        j = len(self.taken)
        return pair_code(*self.steps[j][:2]) if j < len(self.steps) else None

    def take(self) -> dict[int, int]:
        """Take the next merge: the changes of pair counts."""
        a, b, new = self.steps[len(self.taken)]
        out = {pair_code(a, b): -self.made[len(self.taken)]}
        self.taken.append(new)
        for x in self._chain(new, self.ends):
            self.tail[x] = new
            for y, n in self.after.get(x, ()):
                h = self.head.get(y, y)
                out[b << 32 | h] = out.get(b << 32 | h, 0) - n
                out[new << 32 | h] = out.get(new << 32 | h, 0) + n
        for y in self._chain(new, self.begins):
            self.head[y] = new
            for x, n in self.before.get(y, ()):
                t = self.tail.get(x, x)
                out[t << 32 | a] = out.get(t << 32 | a, 0) - n
                out[t << 32 | new] = out.get(t << 32 | new, 0) + n
        return out

    def fix(self) -> tuple[int, np.ndarray, np.ndarray] | None:
        """For :meth:`Segment.relabelled`: the merges that were not taken are taken back."""
        parts: list[list[int]] = []
        for j, (a, b, c) in enumerate(self.steps):
            both = [[s] if s < self.first else parts[s - self.first] for s in (a, b)]
            parts.append([c] if j < len(self.taken) else both[0] + both[1])
        if len(self.taken) == len(self.steps):
            return None
        heads = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
        return self.first, heads, np.array([s for p in parts for s in p], np.int32)


def _tried(segments: DataFrame, fix, steps: list[tuple[int, int, int]], first: int) -> tuple[DataFrame, _Tried]:
    """The segments with ``steps`` made, after the changes ``fix`` of ids."""

    def change(seg: Segment) -> tuple:
        seg, made, (codes, sums) = (seg.relabelled(fix) if fix else seg).tried(steps)
        return seg, np.concatenate((-1 - np.arange(len(made)), codes)), np.concatenate((made, sums))

    out, counted = _pass(segments, change)
    rows = counted.toArrow()
    return out, _Tried(steps, first, zip(rows["code"].to_pylist(), rows["c"].to_pylist()))


class _PairTable:
    """The most frequent pairs, with exact counts; ``last``: no pair that is
    not kept comes before this (-count, code) in the order of training."""

    def __init__(self, rows: list[tuple[int, int]], most: int):
        self.most = most
        self.counts = dict(rows)
        self.last = (-rows[-1][1], rows[-1][0]) if len(rows) >= most else None
        self.heap = [(-c, k) for k, c in rows]
        heapify(self.heap)

    def best(self) -> int | None:
        """The next pair of sequential training; None where it is not known to be kept."""
        while self.heap:
            c, k = self.heap[0]
            if self.counts.get(k) == -c:
                return k if self.last is None or (c, k) <= self.last else None
            heappop(self.heap)
        return None

    def change(self, deltas: dict[int, int], new: int) -> None:
        for k, d in deltas.items():
            fresh = k >> 32 == new or k & 0xFFFFFFFF == new
            if not fresh and k not in self.counts:
                continue  # a pair that is not kept sinks further
            c = self.counts[k] = self.counts.get(k, 0) + d
            if c <= 0:
                del self.counts[k]
            else:
                heappush(self.heap, (-c, k))
        if len(self.counts) > 4 * self.most:
            kept = nsmallest(2 * self.most, ((-c, k) for k, c in self.counts.items()))
            self.last = kept[-1] if self.last is None else min(self.last, kept[-1])
            self.counts = {k: -c for c, k in kept}
            self.heap = kept

    def guess(self, most: int, name) -> list[tuple[int, int, int]]:
        """Likely next merges (left, right, id), the first one certain: counts
        of new pairs are estimated as if neighbours were independent.
        ``name(a, b)`` gives the merged id and whether it is a new one."""
        codes, counts = (np.fromiter(x, np.int64, len(self.counts)) for x in (self.counts.keys(), self.counts.values()))
        first, second = (dict(enumerate(np.bincount(x, counts).tolist())) for x in (codes >> 32, codes & 0xFFFFFFFF))
        top = np.lexsort((codes, -counts))[: 8 * most]
        likely = dict(zip(codes[top].tolist(), counts[top].astype(float).tolist()))
        out = []
        while likely and len(out) < most:
            k = min(likely, key=lambda k: (-likely[k], k))
            n, a, b = likely.pop(k), k >> 32, k & 0xFFFFFFFF
            if n < 1:
                break
            c, new = name(a, b)
            out.append((a, b, c))
            if not new:
                break
            for q, m in list(likely.items()):
                x, y = q >> 32, q & 0xFFFFFFFF
                if y == a:
                    moved, joined = n * m / max(second.get(a, 1), 1), pair_code(x, c)
                elif x == b:
                    moved, joined = n * m / max(first.get(b, 1), 1), pair_code(c, y)
                else:
                    continue
                likely[q] = m - min(m, moved)
                likely[joined] = min(m, moved)
            first[c] = second[c] = n
            second[a] = second.get(a, 0) - n
            first[b] = first.get(b, 0) - n
        return out


def _disjoint(pairs: list[int], most: int) -> list[tuple[int, int]]:
    """Pairs in order, without those that share a symbol with an earlier one."""
    out, used = [], set()
    for k in pairs:
        a, b = k >> 32, k & 0xFFFFFFFF
        if a in used or b in used or (a == b and out):
            continue
        out.append((a, b))
        used.update((a, b))
        if len(out) >= most:
            break
    return out


def train_bpe(df: DataFrame, col: str = "text", vocab_size: int = 20000, specials=DEFAULT_SPECIALS,
              pretokenize: str = "whitespace", top_pairs: int = 20_000, snapshot_every: int = 256, max_rounds: int | None = None,
              batch: str = "exact"):
    """Returns ``(vocab, merges)`` DataFrames.

    ``vocab``: ``(token, id, special)``; ``merges``: ``(rank, left, right, id,
    round)``.  Training ends at ``vocab_size`` ids or when no pair is left.
    ``batch="exact"`` equals sequential training; ``"greedy"`` takes all
    frequent pairs of a round that share no symbol (deterministic, fewer
    rounds, not the same merges)."""
    if batch not in ("exact", "greedy"):
        raise ValueError(f"unknown batch {batch!r}")
    spark: SparkSession = df.sparkSession
    specials = list(specials)
    st = cut_lineage(units(df, col, pretokenize), "bpe-units")
    segments, alphabet = _segments(st)
    drop_stage(st)
    tokens = specials + alphabet  # id -> string, bounded by vocab_size
    id_of = {t: i for i, t in enumerate(tokens)}
    ids = np.zeros(max(map(ord, alphabet), default=0) + 1, np.int32)
    ids[[ord(c) for c in alphabet]] = np.arange(len(alphabet), dtype=np.int32) + len(specials)
    segments, top = _recounted(segments, top_pairs, lambda seg: Segment(ids[seg.symbols], seg.starts, seg.counts))
    table, live = _PairTable(top, top_pairs), LIVE
    merges: list[tuple[int, int, int, int, int]] = []
    ranks: dict[int, tuple[int, int]] = {}  # merges since the last snapshot: an old token's pairs may be merged anew by them
    fix = None  # ids of the last pass that are not the present ones
    rnd, tries, done = 0, 8, 0
    expected: list[tuple[int, int, int]] | None = None  # merges that the round may take
    def name_of() -> Callable[[int, int], tuple[int, bool]]:
        named: dict[str, int] = {}
        spelled: dict[int, str] = {}

        def name(a: int, b: int) -> tuple[int, bool]:
            text = spelled.get(a, tokens[a] if a < len(tokens) else "") + spelled.get(b, tokens[b] if b < len(tokens) else "")
            old = id_of.get(text, named.get(text))
            if old is not None:
                return old, False
            named[text] = c = len(tokens) + len(named)
            spelled[c] = text
            return c, True

        return name

    def begin_round() -> list[tuple[int, int, int]]:
        left, name = vocab_size - len(tokens), name_of()
        if batch == "exact":
            return table.guess(min(tries, left, MOST_STEPS), name)
        order = nsmallest(8 * MOST_STEPS, table.counts, key=lambda k: (-table.counts[k], k))
        steps = []
        for a, b in _disjoint(order, min(left, MOST_STEPS)):
            c, new = name(a, b)
            steps.append((a, b, c))
            if not new:
                break
        return steps

    while len(tokens) < vocab_size:
        if expected is None and max_rounds is not None and rnd >= max_rounds:
            break
        if table.best() is None:
            if expected is not None:
                expected, tries, rnd = None, max(4, 2 * done + 2), rnd + 1
                continue
            if not ranks:
                break
            segments, top = _recounted(segments, top_pairs, lambda seg, fix=fix: seg.relabelled(fix) if fix else seg)
            table, ranks, fix = _PairTable(top, top_pairs), {}, None
            continue
        first = len(tokens)
        if batch == "exact":
            pairs, live = _next_merges(segments, fix, table, min(MOST_TRIED, vocab_size - first), live, name_of())
        else:
            if len(ranks) >= snapshot_every:
                ranks = {}
            expected, done = begin_round(), 0
            pairs = [m[:2] for m in expected]
        segments, tried = _tried(segments, fix, [(*m, first + k) for k, m in enumerate(pairs)], first)
        again = None  # the ranks with which an old token's merge is made
        while len(tokens) < vocab_size:
            if expected is None:
                if table.best() is None or batch != "exact" or (max_rounds is not None and rnd >= max_rounds):
                    break
                if len(ranks) >= snapshot_every:
                    ranks = {}
                expected, done = begin_round(), 0
            code = table.best() if batch == "exact" else pair_code(*expected[done][:2])
            if code is None:
                break
            if code != pair_code(*expected[done][:2]):
                expected, tries, rnd = None, max(4, 2 * done + 2), rnd + 1
                continue
            if code != tried.next():
                break
            a, b = code >> 32, code & 0xFFFFFFFF
            text = tokens[a] + tokens[b]
            c = id_of.get(text, len(tokens))
            merges.append((len(merges), a, b, c, rnd))
            ranks[code] = (len(ranks), c)
            done += 1
            if c < len(tokens):  # the text of a token that exists: its pairs may not be kept
                again = ranks
            else:
                id_of[text] = c
                tokens.append(text)
                table.change(tried.take(), c)
            if again is not None or done == len(expected):
                expected, tries, rnd = None, max(4, 2 * done + 2), rnd + 1
            if again is not None:
                break
        fix = tried.fix()
        if again is not None and len(tokens) < vocab_size:
            segments, top = _recounted(segments, top_pairs, lambda seg, fix=fix, again=again: (seg.relabelled(fix) if fix else seg).indexed().merged(again))
            table, ranks, fix = _PairTable(top, top_pairs), {}, None
    drop_stage(segments)
    vocab = spark.createDataFrame([(t, i, i < len(specials)) for i, t in enumerate(tokens)], VOCAB_SCHEMA)
    merges_df = spark.createDataFrame(merges, MERGES_SCHEMA)
    return vocab, merges_df


def encode_bpe(df: DataFrame, vocab: DataFrame, merges: DataFrame, key: str = "doc_id", col: str = "text",
               pretokenize: str = "whitespace", out: str = "ids") -> DataFrame:
    """T4 (BPE): encode **distinct** words once in an Arrow-batched
    ``mapInPandas`` (merge ranks shipped with the function: bounded by the
    vocabulary), join back on the unit, and concatenate per row in order.  Whole
    lines are encoded row by row, many at once."""
    spark = df.sparkSession
    v = vocab.filter(~F.col("special")).select("token", "id").collect()
    char_ids = {r["token"]: r["id"] for r in v if len(r["token"]) == 1}
    ranks = {pair_code(r["left"], r["right"]): (r["rank"], r["id"]) for r in merges.collect()}
    if pretokenize == "none":
        keys = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key)
        if keys.isEmpty():
            return _encode_rows(df, key, col, char_ids, ranks, out)
        # Rows of a key get the units of all of them, by their number in the text.
        once = _encode_rows(df.join(keys, key, "left_anti"), key, col, char_ids, ranks, out)
        df = df.join(keys, key, "left_semi")
    ex = df.select(key, F.posexplode(_unit_list(col, pretokenize)).alias("_p", "unit"))
    distinct = ex.select("unit").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"unit": b["unit"], "uids": [apply_merges([char_ids[c] for c in u if c in char_ids], ranks) for u in b["unit"]]})

    if pretokenize == "none":
        coded = _encode_rows(distinct, "unit", "unit", char_ids, ranks, "uids")
    else:
        coded = distinct.mapInPandas(run, "unit string, uids array<int>")
    j = ex.join(coded, "unit")
    g = j.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_p", "uids"))).alias("_l"))
    res = g.select(key, F.flatten(F.transform("_l", lambda x: x["uids"])).alias(out))
    keys = df.select(key)
    res = keys.join(res, key, "left").select(key, F.coalesce(out, F.array().cast("array<int>")).alias(out))
    return once.unionByName(res) if pretokenize == "none" else res


def _encode_rows(df: DataFrame, key: str, col: str, char_ids: dict[str, int], ranks: dict, out: str) -> DataFrame:
    """Ids of each row's lines, in order; none for a row without a key.  Lines
    seldom repeat: many rows are merged at once where they are, and nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = Lines(char_ids, ranks)
        for b in batches:
            begun = 0
            for texts, end in _some_texts(b.column(1), ENCODED_SYMBOLS):
                ids, ends = lines.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(begun, end - begun), lists], names=["key", "ids"])
                begun = end

    schema = Ty.StructType([Ty.StructField("key", df.schema[key].dataType), Ty.StructField("ids", Ty.ArrayType(Ty.IntegerType()))])
    coded = df.select(F.col(key).alias("key"), F.col(col).alias("text")).mapInArrow(run, schema)
    return coded.select(F.col("key").alias(key), F.when(F.col("key").isNotNull(), F.col("ids")).otherwise(F.array().cast("array<int>")).alias(out))


def _some_texts(column: pa.Array, most: int) -> Iterator[tuple[list[str], int]]:
    """Texts of about ``most`` characters together, with the row that ends them."""
    texts: list[str] = []
    size = 0
    for i, text in enumerate(column.to_pylist(), 1):
        texts.append(text or "")
        size += len(texts[-1])
        if size >= most or i == len(column):
            yield texts, i
            texts, size = [], 0


def save_tokenizer(vocab: DataFrame, merges: DataFrame, path: str) -> None:
    """Persist vocabulary and merges as two parquet tables."""
    vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    merges.write.mode("overwrite").parquet(f"{path}/merges")


def load_tokenizer(spark: SparkSession, path: str, build=None):
    """Load ``(vocab, merges)`` when present, else build with ``build()``
    and save."""
    from tokenloom.sources.sinks import output_exists

    if output_exists(spark, f"{path}/vocab") and output_exists(spark, f"{path}/merges"):
        return spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/merges")
    if build is None:
        raise FileNotFoundError(path)
    vocab, merges = build()
    save_tokenizer(vocab, merges, path)
    return spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/merges")
