"""Byte-level BPE, exact and linear.

Bytes stand as Latin-1 characters in an Aho-Corasick automaton over the
vocabulary.  A word takes the longest match at each place and backtracks to
shorter ones when a token cannot stand beside the one before: two tokens may
be neighbours if BPE, run on their bytes alone, would leave that border.
Those answers are memoised per pair of tokens.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from tokenloom.llm.common import id_text, map_rows

_CODECS: dict = {}


class ByteBPE:
    """Encoder and decoder for a rank file (base64 token, rank, per line)."""

    MEMO = 1 << 19

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.trie = ahocorasick.Automaton()
        for t, r in ranks.items():
            self.trie.add_word(t.decode("latin-1"), r)
        self.trie.make_automaton()
        self.beside: dict[tuple[int, int], bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.words: dict[str, bytes] = {}

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge last makes this one (None: a byte)."""
        if token not in self.halves:
            parts = [bytes([b]) for b in self.token[token]]
            while len(parts) > 2:
                ranked = [(self.ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
                best, i = min(ranked)
                if best >= token:
                    raise ValueError(f"token {token} cannot be reached by merges")
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self.halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.halves[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border of two neighbouring tokens.

        Their last merges are undone, latest first; a crossing merge that
        would have come before one of those undone breaks the border.
        """
        key = (left, right)
        known = self.beside.get(key)
        if known is not None:
            return known
        # ``limit``: merges from here on had not been made when left and right stood so;
        # on equal ranks the leftmost goes first, so undoing the right one allows equality.
        limit, answer = 1 << 62, True
        while True:
            crossing = self.ranks.get(self.token[left] + self.token[right])
            if crossing is not None and crossing < limit:
                answer = False
                break
            l, r = self._split(left), self._split(right)
            if l and (left > right or not r):
                limit, left = left, l[1]
            elif r:
                limit, right = right + 1, r[0]
            else:
                break
        if len(self.beside) >= 1 << 20:
            self.beside.clear()
        self.beside[key] = answer
        return answer

    def encode_word(self, raw: bytes) -> list[int]:
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        n = len(raw)
        fits: list[list[int]] = [[] for _ in range(n)]  # tokens from each place, shortest first
        for end, r in self.trie.iter(raw.decode("latin-1")):
            fits[end - len(self.token[r]) + 1].append(r)
        dead = bytearray(n + 1)  # places from which no tokens lead on
        path: list[int] = []
        tries: list[int] = [len(fits[0]) - 1]
        at = 0
        while at < n:
            i, options = tries[-1], fits[at]
            while i >= 0:
                t = options[i]
                if not dead[at + len(self.token[t])] and (not path or self.compatible(path[-1], t)):
                    break
                i -= 1
            if i >= 0:
                tries[-1] = i - 1
                path.append(options[i])
                at += len(self.token[options[i]])
                if at < n:
                    tries.append(len(fits[at]) - 1)
            else:
                dead[at] = 1
                tries.pop()
                at -= len(self.token[path.pop()])
        return path

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, each match of the pattern by itself."""
        memo, out = self.words, []
        for w in self.find(text):
            ids = memo.get(w)
            if ids is None:
                ids = np.asarray(self.encode_word(w.encode("utf-8")), "<u4").tobytes()
                if len(w) <= 64:
                    if len(memo) >= self.MEMO:
                        memo.clear()
                    memo[w] = ids
            out.append(ids)
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.tolist()))


def codec(path: str, pattern: str) -> ByteBPE:
    if (path, pattern) not in _CODECS:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        _CODECS[path, pattern] = ByteBPE(ranks, pattern)
    return _CODECS[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """doc_id, ids (if wanted), n_tokens, ids_sha256, decoded_sha256 per row.

    Null text is empty and has no tokens.  Any id, null too, is passed on.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path, pattern)
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                part, out = pdf.iloc[at : at + 256], []
                for text in part["text"]:
                    ids = c.encode(text)
                    row = [len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(c.decode(ids)).hexdigest()]
                    out.append([*row, ids.astype(np.int32)] if with_ids else row)
                names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"]
                done = pd.DataFrame(out, columns=names if with_ids else names[:3])
                done.insert(0, "doc_id", part["doc_id"].to_numpy())
                yield done

    return map_rows(
        id_text(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    )
