"""Symbol sequences of BPE inside one task: merging, and units with an inverted
index from symbol pairs to the places that hold them.

A segment holds some thousand distinct units of the corpus.  It never changes
while merges are learned: a unit's present symbols are its stored ones with
the merges since then applied, so a lost task is simply run again.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np

UNIT_FIELDS = "seg long, symbols binary, starts binary, counts binary"
PAIR_FIELDS = "codes binary, sums binary"
FLAGS = 1 << 22  # of pairs by a hash


def pair_code(a: int, b: int) -> int:
    return a << 32 | b


def apply_merges(sym: list[int], ranks: dict[int, tuple[int, int]]) -> list[int]:
    """Apply ranked merges, lowest rank first and left to right: a heap of
    candidate positions over a linked list of symbols, n log n in the length.
    ``ranks`` maps a pair code to (rank, merged id)."""
    n = len(sym)
    heap = []
    for i in range(n - 1):
        r = ranks.get(sym[i] << 32 | sym[i + 1])
        if r is not None:
            heap.append(r[0] << 32 | i)
    if not heap:
        return sym
    heapify(heap)
    sym = list(sym)
    after = list(range(1, n + 1))  # n: no symbol
    before = list(range(-1, n - 1))
    while heap:
        top = heappop(heap)
        rank, i = top >> 32, top & 0xFFFFFFFF
        a, j = sym[i], after[i]
        if a < 0 or j >= n:
            continue
        r = ranks.get(a << 32 | sym[j])
        if r is None or r[0] != rank:  # one of the two has been merged meanwhile
            continue
        c = sym[i] = r[1]
        sym[j] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            r = ranks.get(c << 32 | sym[k])
            if r is not None:
                heappush(heap, r[0] << 32 | i)
        h = before[i]
        if h >= 0:
            r = ranks.get(sym[h] << 32 | c)
            if r is not None:
                heappush(heap, r[0] << 32 | h)
    return [s for s in sym if s >= 0]


class _Replay:
    """Merges applied to the units of a segment one after the other, all places
    of a pair at once.  Places come from the segment's index, those of pairs
    with a merged symbol from the merge that made them, so a merge costs what
    it touches.  Symbols are linked as in :func:`apply_merges`: a merged one
    stands at its left place, the right place holds -1."""

    def __init__(self, seg: Segment, merges=None):
        """``merges``: those to come; None: any, of pairs in the segment's index."""
        self.seg, self.any = seg, merges is None
        n = len(seg.symbols)
        self.symbols = seg.symbols.copy()
        self.after = np.arange(1, n + 1, dtype=np.int32)
        self.after[seg.starts[1:] - 1] = -1
        self.before = np.arange(-1, n - 1, dtype=np.int32)
        self.before[seg.starts[:-1]] = -1
        self.at = _NOTHING  # where the last merge was made
        self.made: dict[int, list[np.ndarray]] = {}
        self.lefts: dict[int, set[int]] = {}  # symbol -> left ones of the pairs to merge with it on the right
        self.rights: dict[int, set[int]] = {}
        for a, b, _ in merges or ():
            self.lefts.setdefault(b, set()).add(a)
            self.rights.setdefault(a, set()).add(b)

    def places(self, a: int, b: int) -> np.ndarray:
        """Where the pair (a, b) begins, in order."""
        code, made = pair_code(a, b), self.made.pop(pair_code(a, b), [])
        at = self.seg.places(code)
        if made:
            at = np.unique(np.concatenate([at, *made]))
        at = at[self.symbols[at] == a]
        next_ = self.after[at]
        return at[(next_ >= 0) & (self.symbols[next_] == b)]

    def merge(self, a: int, b: int, c: int, count: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Replace each pair (a, b) by c, left to right.  With ``count``: codes
        of pairs and the changes of their counts, a code perhaps more than once."""
        symbols, after, before = self.symbols, self.after, self.before
        at = self.places(a, b)
        second = after[at]
        if a == b and len(at):  # of overlapping places every other one
            k = np.arange(len(at))
            linked = np.append(False, second[:-1] == at[1:])
            taken = (k - np.maximum.accumulate(np.where(linked, 0, k))) % 2 == 0
            at, second = at[taken], second[taken]
        self.at = at
        if not len(at):
            return _NOTHING, _NOTHING
        x, y = before[at], after[second]
        follows = np.append(False, x[1:] == second[:-1])  # the pair on its left is merged too
        left, right = (x >= 0) & ~follows, y >= 0
        x, xs, ys = x[left], symbols[x[left]], symbols[y[right]]
        ys_new = np.where(np.append(follows[1:], False)[right], c, ys)
        symbols[at] = c
        symbols[second] = -1
        after[at] = y
        before[y[right]] = at[right]
        if self.any:
            self._keep(xs, x, lambda s: pair_code(s, c))
            self._keep(ys_new, at[right], lambda s: pair_code(c, s))
        for s in self.lefts.get(c, ()):
            self.made.setdefault(pair_code(s, c), []).append(x[xs == s])
        for s in self.rights.get(c, ()):
            self.made.setdefault(pair_code(c, s), []).append(at[right][ys_new == s])
        if not count:
            return _NOTHING, _NOTHING
        w = self.seg.counts[np.searchsorted(self.seg.starts, at, side="right") - 1]
        xs, ys, ys_new = (v.astype(np.int64) for v in (xs, ys, ys_new))
        codes = np.concatenate(([pair_code(a, b)], xs << 32 | a, xs << 32 | c, b << 32 | ys, c << 32 | ys_new))
        return codes, np.concatenate(([-w.sum()], -w[left], w[left], -w[right], w[right]))

    def _keep(self, symbols: np.ndarray, at: np.ndarray, code) -> None:
        order = np.argsort(symbols, kind="stable")
        symbols, at = symbols[order], at[order]
        first = np.flatnonzero(np.diff(symbols, prepend=-1)).tolist()
        for i, j in zip(first, [*first[1:], len(at)]):
            self.made.setdefault(code(int(symbols[i])), []).append(at[i:j])


_NOTHING = np.zeros(0, np.int64)
_ODD = np.random.default_rng(5).integers(1, 1 << 62, 1024, np.uint64) * np.uint64(2) + np.uint64(1)


def _hashed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number below ``FLAGS`` for each pair."""
    return (a.astype(np.uint32) * np.uint32(2654435761) + b.astype(np.uint32) * np.uint32(40503)) >> np.uint32(10)


def summed(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each code once, with the sum of its values."""
    if not len(codes):
        return codes, values
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[first], np.add.reduceat(values[order], first)


class Segment:
    """Units (symbols, count) and the places of each pair."""

    def __init__(self, symbols, starts, counts, pairs=None, heads=None, posts=None):
        self.symbols, self.starts, self.counts = symbols, starts, counts
        self.pairs, self.heads, self.posts = pairs, heads, posts
        self.more = None  # whether a symbol's unit comes more than once, when asked for

    @classmethod
    def build(cls, units: list[list[int]], counts: list[int]) -> Segment:
        """Units of fewer than two symbols have no pairs and are left out."""
        both = [(u, c) for u, c in zip(units, counts) if len(u) > 1]
        sizes = np.array([len(u) for u, _ in both], np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        symbols = np.fromiter((s for u, _ in both for s in u), np.int32, int(starts[-1]))
        return cls(symbols, starts, np.array([c for _, c in both], np.int64)).indexed()

    @classmethod
    def of_texts(cls, units: list[str], counts: list[int]) -> Segment:
        """Units as code points."""
        both = [(u, c) for u, c in zip(units, counts) if len(u) > 1]
        starts = np.concatenate(([0], np.cumsum([len(u) for u, _ in both]))).astype(np.int64)
        return cls(code_points("".join(u for u, _ in both)), starts, np.array([c for _, c in both], np.int64))

    def _inside(self) -> np.ndarray:
        """Whether the pair that begins at a place lies in one unit."""
        inside = np.ones(max(len(self.symbols) - 1, 0), bool)
        inside[self.starts[1:-1] - 1] = False
        return inside

    def _again(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places that lie in units that come more than once, and how often more."""
        if self.more is None:
            self.more = np.repeat(self.counts > 1, np.diff(self.starts))
        at = at[self.more[at]]
        return at, self.counts[np.searchsorted(self.starts, at, side="right") - 1] - 1

    def _sums(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each pair that begins at one of the places, once, with its count."""
        s = self.symbols
        k = int(s.max(initial=0)) + 1
        more, times = self._again(at)
        if k <= 4096:
            sums = np.bincount(s[at].astype(np.int64) * k + s[at + 1], minlength=k * k)
            np.add.at(sums, s[more].astype(np.int64) * k + s[more + 1], times)
            at = np.flatnonzero(sums)
            return at // k << 32 | at % k, sums[at]
        at = np.concatenate((at, more))
        return summed(s[at].astype(np.int64) << 32 | s[at + 1], np.concatenate((np.ones(len(at) - len(more), np.int64), times)))

    def relabelled(self, fix: tuple[int, np.ndarray, np.ndarray]) -> Segment:
        """With symbols from ``first`` on replaced by those that they stand for:
        ``fix`` is (first, heads, parts), the symbols ``parts[heads[k] :
        heads[k + 1]]`` for ``first + k``.  Units of one symbol are left out."""
        first, heads, parts = fix
        s, starts = self.symbols, self.starts
        at = np.flatnonzero(s >= first)
        if len(at):
            named = s[at] - first
            sizes = np.diff(heads)[named]
            if (sizes == 1).all():
                s = s.copy()
                s[at] = parts[heads[named]]
            else:
                times = np.ones(len(s), np.int64)
                times[at] = sizes
                ends = np.concatenate(([0], np.cumsum(times)))
                inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                s = np.repeat(s, times)
                s[np.repeat(ends[at], sizes) + inner] = parts[np.repeat(heads[named], sizes) + inner]
                starts = ends[starts]
        sizes = np.diff(starts)
        kept = sizes > 1
        if kept.all():
            return Segment(s, starts, self.counts)
        return Segment(s[np.repeat(kept, sizes)], np.concatenate(([0], np.cumsum(sizes[kept]))).astype(np.int64), self.counts[kept])

    def tried(self, steps: list[tuple[int, int, int]]) -> tuple[Segment, np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """The merges ``steps`` made one after the other, their ids not yet in
        use: the new segment (with units of one symbol, so that merges can be
        taken back), how often each was made, and the counts of all pairs with
        one of the new symbols."""
        replay = _Replay(self.indexed({pair_code(a, b) for a, b, _ in steps}), steps)
        made = np.zeros(len(steps), np.int64)
        for j, m in enumerate(steps):
            replay.merge(*m)
            made[j] = len(replay.at) + self._again(replay.at)[1].sum()
        held = replay.symbols >= 0
        sizes = np.add.reduceat(held, self.starts[:-1], dtype=np.int64) if len(self.counts) else _NOTHING
        new = Segment(replay.symbols[held], np.concatenate(([0], np.cumsum(sizes))).astype(np.int64), self.counts)
        fresh = new.symbols >= min(c for _, _, c in steps)
        at = np.flatnonzero((fresh[:-1] | fresh[1:]) & new._inside())
        return new, made, new._sums(at)

    def pieces(self, live: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """The units cut at all pairs that are not in ``live`` (sorted codes):
        each distinct piece of two symbols or more as (hash, symbols, how often)."""
        s = self.symbols
        at, _ = self._found(live)
        if not len(at):
            return _NOTHING, [], _NOTHING
        first = np.flatnonzero(np.diff(at, prepend=-2) > 1)  # pairs side by side make a piece
        starts, sizes = at[first], np.diff(np.append(first, len(at))) + 1
        heads = np.cumsum(sizes) - sizes
        held = np.zeros(len(s), bool)
        held[at] = True
        held[starts + sizes - 1] = True
        flat = s[held]
        inner = np.arange(len(flat)) - np.repeat(heads, sizes)
        mixed = (flat.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= _ODD[inner & 1023]
        hashes = np.add.reduceat(mixed, heads)
        order = np.argsort(hashes)
        one = np.flatnonzero(np.diff(hashes[order], prepend=hashes[order[0]] + np.uint64(1)))
        times = np.ones(len(starts), np.int64)
        if (self.counts > 1).any():
            times = self.counts[np.searchsorted(self.starts, starts, side="right") - 1]
        how_often = np.add.reduceat(times[order], one)
        one = order[one]
        texts = [flat[i:j].tobytes() for i, j in zip(heads[one].tolist(), (heads[one] + sizes[one]).tolist())]
        return hashes[one], texts, how_often

    def _found(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pairs with one of the sorted codes begin, and the numbers of these."""
        if not len(wanted) or len(self.symbols) < 2:
            return _NOTHING, _NOTHING
        k = int(self.symbols.max()) + 1
        if k <= 4096:
            number = np.full(k * k, -1, np.int32)
            there = np.flatnonzero((wanted >> 32 < k) & (wanted & 0xFFFFFFFF < k))
            number[(wanted[there] >> 32) * k + (wanted[there] & 0xFFFFFFFF)] = there
            which = number[self.symbols[:-1] * np.int32(k) + self.symbols[1:]]
            at = np.flatnonzero(self._inside() & (which >= 0))
            return at, which[at]
        flags = np.zeros(FLAGS, bool)  # a hash first, then the pairs themselves
        flags[_hashed(wanted >> 32, wanted & 0xFFFFFFFF)] = True
        at = np.flatnonzero(self._inside() & flags[_hashed(self.symbols[:-1], self.symbols[1:])])
        codes = self.symbols[at].astype(np.int64) << 32 | self.symbols[at + 1]
        which = np.minimum(np.searchsorted(wanted, codes), len(wanted) - 1)
        right = wanted[which] == codes
        return at[right], which[right]

    def most_frequent_merges(self, least: int, most: int, name) -> list[tuple[int, int]]:
        """Sequential training on these units as long as a pair comes ``least``
        times, ``most`` merges at most, up to one whose ``name(a, b)`` is not new."""
        replay = _Replay(self.indexed())
        counts = dict(zip(*(x.tolist() for x in self.pair_counts())))
        heap = [(-n, k) for k, n in counts.items() if n >= least]
        heapify(heap)
        out: list[tuple[int, int]] = []
        while heap and len(out) < most:
            n, k = heappop(heap)
            if counts.get(k) != -n:
                continue
            a, b = k >> 32, k & 0xFFFFFFFF
            out.append((a, b))
            c, new = name(a, b)
            if not new:
                break
            codes, changes = summed(*replay.merge(a, b, c, count=True))
            for q, d in zip(codes.tolist(), changes.tolist()):
                counts[q] = m = counts.get(q, 0) + d
                if m >= least:
                    heappush(heap, (-m, q))
        return out

    def all_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Counts of all pairs, without an index."""
        return self._sums(np.flatnonzero(self._inside()))

    def indexed(self, only: set[int] | None = None) -> Segment:
        """With the places of every pair, or of those in ``only``, in order."""
        if only is not None:
            wanted = np.array(sorted(only), np.int64)
            at, which = self._found(wanted)
            which = which.astype(np.uint16 if len(wanted) < 1 << 16 else np.int64)
            order = np.argsort(which, kind="stable")
            n = np.bincount(which, minlength=len(wanted))
            self.pairs, self.posts = wanted, at[order].astype(np.int32)
            self.heads = np.concatenate(([0], np.cumsum(n))).astype(np.int64)
            return self
        s = self.symbols.astype(np.int64)
        at = np.flatnonzero(self._inside())
        codes = s[at] << 32 | s[at + 1]
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        first = np.flatnonzero(np.diff(codes, prepend=-1))
        self.pairs, self.posts = codes[first], at[order].astype(np.int32)
        self.heads = np.concatenate((first, [len(codes)])).astype(np.int64)
        return self

    def pair_counts(self) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.pairs):
            return self.pairs, self.pairs
        unit = np.repeat(np.arange(len(self.counts), dtype=np.int32), np.diff(self.starts))
        return self.pairs, np.add.reduceat(self.counts[unit[self.posts]], self.heads[:-1])

    def unit(self, u: int) -> list[int]:
        return self.symbols[self.starts[u] : self.starts[u + 1]].tolist()

    def places(self, code: int) -> np.ndarray:
        """Where a pair begins in the stored symbols."""
        i = int(np.searchsorted(self.pairs, code))
        if i == len(self.pairs) or self.pairs[i] != code:
            return self.posts[:0]
        return self.posts[self.heads[i] : self.heads[i + 1]]

    def step_deltas(self, ranks: dict, steps) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each step (a, b, c), one after the other, the changes of pair
        counts (codes, changes); ``ranks``: merges since the segment was built,
        each with a new id."""
        since = _in_order(ranks)
        replay = _Replay(self, [*since, *steps])
        for m in since:
            replay.merge(*m)
        return [summed(*replay.merge(*m, count=True)) for m in steps]

    def merged(self, ranks: dict) -> Segment:
        """The merges applied, as :func:`apply_merges` does."""
        since = _in_order(ranks)
        replay = _Replay(self, since)
        again = _NOTHING
        for k, (a, b, c) in enumerate(since):
            if k == len(since) - 1 and any(c in (x, y) for x, y, _ in since):
                # Only the last id may be an old one: pairs that were merged before can arise anew.
                again = np.unique(np.searchsorted(self.starts, replay.places(a, b), side="right") - 1)
                if len(again):
                    replay = _Replay(self, since)
                    for m in since[:-1]:
                        replay.merge(*m)
            replay.merge(a, b, c)
        new = replay.symbols
        sizes = np.add.reduceat(new >= 0, self.starts[:-1], dtype=np.int64) if len(self.counts) else _NOTHING
        for u in again.tolist():
            whole = apply_merges(self.unit(u), ranks)
            new[self.starts[u] : self.starts[u + 1]] = -1
            new[self.starts[u] : self.starts[u] + len(whole)] = whole
            sizes[u] = len(whole)
        kept = sizes > 1  # a unit of one symbol has no pairs
        symbols = new[(new >= 0) & np.repeat(kept, np.diff(self.starts))]
        starts = np.concatenate(([0], np.cumsum(sizes[kept]))).astype(np.int64)
        return Segment(symbols, starts, self.counts[kept])

    def units_row(self) -> tuple:
        """As bytes; symbols by two bytes where that does."""
        small = self.symbols.max(initial=0) < 1 << 16
        return (b"2" if small else b"4") + self.symbols.astype(np.uint16 if small else np.int32).tobytes(), self.starts.tobytes(), self.counts.tobytes()

    @classmethod
    def of_pieces(cls, pieces: list[bytes], counts: list[int]) -> Segment:
        """Units of :meth:`pieces`."""
        starts = np.concatenate(([0], np.cumsum([len(p) // 4 for p in pieces]))).astype(np.int64)
        return cls(np.frombuffer(b"".join(pieces), np.int32), starts, np.array(counts, np.int64))

    @classmethod
    def of_units_row(cls, symbols: bytes, starts: bytes, counts: bytes) -> Segment:
        kind = np.uint16 if symbols[:1] == b"2" else np.int32
        return cls(np.frombuffer(symbols, kind, offset=1).astype(np.int32), np.frombuffer(starts, np.int64), np.frombuffer(counts, np.int64))

    def row(self) -> tuple:
        return tuple(x.tobytes() for x in (self.symbols, self.starts, self.counts, self.pairs, self.heads, self.posts))

    @classmethod
    def of_row(cls, *row) -> Segment:
        kinds = (np.int32, np.int64, np.int64, np.int64, np.int64, np.int32)
        return cls(*(np.frombuffer(x, k) for x, k in zip(row, kinds)))


class Lines:
    """Encodes texts whose units are lines, all places of a merge at once."""

    def __init__(self, char_ids: dict[str, int], ranks: dict[int, tuple[int, int]]):
        self.ranks, self.merges = ranks, _in_order(ranks)
        self.ids = np.full(max(map(ord, char_ids), default=0) + 2, -1, np.int32)
        for c, i in char_ids.items():
            self.ids[ord(c)] = i
        used: dict[int, int] = {}  # symbol -> its first merge
        for j, (a, b, _) in enumerate(self.merges):
            used.setdefault(a, j)
            used.setdefault(b, j)
        self.early = [used.get(c, len(self.merges)) < j for j, (_, _, c) in enumerate(self.merges)]  # made after a merge of it

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's begin and the last's end."""
        points = code_points("".join(texts))
        ends = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        symbols = self.ids[np.minimum(points, len(self.ids) - 1)]
        held = np.concatenate(([0], np.cumsum(symbols >= 0)))  # characters outside the alphabet vanish
        starts = np.unique(held[np.concatenate((ends, np.flatnonzero(points == ord("\n")) + 1))])
        symbols, ends = symbols[symbols >= 0], held[ends]
        if not len(symbols):
            return symbols, ends
        seg = Segment(symbols, starts, np.ones(len(starts) - 1, np.int64))
        replay = _Replay(seg.indexed({pair_code(a, b) for a, b, _ in self.merges}), self.merges)
        again = []
        for j, m in enumerate(self.merges):
            replay.merge(*m)
            if self.early[j]:
                again.append(replay.at)
        out = replay.symbols
        if again:
            for u in np.unique(np.searchsorted(starts, np.concatenate(again), side="right") - 1).tolist():
                whole = apply_merges(seg.unit(u), self.ranks)
                out[starts[u] : starts[u + 1]] = -1
                out[starts[u] : starts[u] + len(whole)] = whole
        return out[out >= 0], np.concatenate(([0], np.cumsum(out >= 0)))[ends]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.int32)


def _in_order(ranks: dict) -> list[tuple[int, int, int]]:
    """Ranked merges as (left, right, id)."""
    return [(k >> 32, k & 0xFFFFFFFF, c) for k, (_, c) in sorted(ranks.items(), key=lambda m: m[1][0])]
