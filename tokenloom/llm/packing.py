"""Shortest-pack-first histogram packing.

Documents are tokenized, cut into whole sequences and a remainder.  The
histogram of remainder lengths (at most max_len - 1 bins, whatever the input)
is packed longest first into the pattern with most room; patterns are counts,
not documents.  Patterns meet documents again by rank within a length.

Null text is an empty text: one end token.  Repeated rows are packed each, null
ids are ids like any other, an empty table gives no pieces, and a text of any
length is cut into whole sequences and one remainder.
"""

from __future__ import annotations

import codecs
import os
import re
import string
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.llm.common import id_text, map_rows
from tokenloom.session import cut_lineage

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
WORDS_KEPT = 1 << 19  # distinct words that a task remembers at most
WORDS_STAY = 1 << 16  # of them, those that its worker keeps for the next task: met first, so mostly frequent
# Letters that are themselves in NFC and are one letter each in lower case, and the marks that words are cut before.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-įı-ſ"
LETTER_SET = "".join(c for c in map(chr, range(0x180)) if re.fullmatch(f"[{LETTERS}]", c))
MARKS = string.punctuation
# The sign by which byte-level vocabularies write each byte; the space stays and parts words.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _SHOWN]
BYTE_SIGNS = "".join(" " if b == 32 else chr(b) if b in _SHOWN else chr(256 + _HIDDEN.index(b)) for b in range(256))
_TOKENIZERS: dict = {}
_ENCODERS: dict = {}


def _tokenizer(path: str):
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return _TOKENIZERS[path]


class WordEncoder:
    """Ids of whole texts by their white-space words.

    The tokenizer drops white space and none of its patterns spans it, and its
    special tokens hold none: a text's ids are those of its words, one after
    the other.  Arrow splits the texts and numbers their distinct words; words
    that differ in case or in ASCII marks at the end share the ids of their
    letters and of the marks.  Each such part is encoded once while it is remembered.
    Only the six ASCII spaces part words here; others stay inside, for the
    tokenizer to handle."""

    def __init__(self, path: str, special_as_text: bool):
        self.path, self.special_as_text = path, special_as_text
        self.known: dict[str, bytes] = {}
        self.model = None  # the tokenizer without its normalizer and patterns

    def __call__(self, texts: list[str]) -> list[bytes]:
        raw = pa.array([t.encode("utf-8", "replace") for t in texts], pa.large_binary()).cast(pa.large_string())
        split = pc.ascii_split_whitespace(raw)  # empty words where spaces begin or end a text
        words = split.flatten().dictionary_encode()
        ids, starts = self.ids(words.dictionary)
        ids, ends = spans(ids, starts, words.indices.to_numpy())
        bounds = np.append(0, ends)[split.offsets.to_numpy()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]

    def ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word, one after the other, and where each word's start."""
        core, mark, letters = parted(words)
        parts = pa.concat_arrays([core, mark]).dictionary_encode()
        at, names = parts.indices.to_numpy(), parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        of_letters = np.zeros(len(names), bool)
        of_letters[at[: len(words)][letters]] = True
        new = self.unknown(names)
        if len(self.known) + len(new) > WORDS_KEPT:
            self.trim()
            new = self.unknown(names)
        self.learn([names[i] for i in new if of_letters[i]], [names[i] for i in new if not of_letters[i]])
        found = [self.known[w] for w in names]
        starts = np.append(0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4))
        ids, ends = spans(np.frombuffer(b"".join(found), "<u4"), starts, at.reshape(2, -1).T.ravel())
        return ids, np.append(0, ends[1::2])

    def unknown(self, names: list[str]) -> list[int]:
        return [i for i, w in enumerate(names) if w not in self.known]

    def trim(self) -> None:
        if len(self.known) > WORDS_STAY:
            self.known = dict(islice(self.known.items(), WORDS_STAY))

    def learn(self, letters: list[str], others: list[str]) -> None:
        """Words of lower-case ``letters`` are one piece each to the tokenizer:
        its vocabulary takes many as one text, and the last id of each is one
        that ends words.  ``others`` go through the whole tokenizer."""
        tok = _tokenizer(self.path)
        tok.encode_special_tokens = self.special_as_text
        if self.model is None:
            self.model, self.ends = _word_model(self.path)
        for at in range(0, len(letters), 1024):
            ws = letters[at : at + 1024]
            text = codecs.charmap_decode(" ".join(ws).encode(), "strict", BYTE_SIGNS)[0]
            ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) != len(ws):  # a vocabulary of another kind
                others = others + ws
                continue
            raw, start = ids.tobytes(), 0
            for w, end in zip(ws, (4 * (ends + 1)).tolist()):
                self.known[w] = raw[start:end]
                start = end
        for at in range(0, len(others), 4096):
            ws = others[at : at + 4096]
            for w, enc in zip(ws, tok.encode_batch_fast(ws, add_special_tokens=False)):
                self.known[w] = np.array(enc.ids, "<u4").tobytes()


def _word_model(path: str):
    """The tokenizer's model for words written as bytes' signs with spaces
    between them, and by id whether it ends words."""
    from tokenizers import Tokenizer, pre_tokenizers

    model = Tokenizer(_tokenizer(path).model)
    model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    vocab, suffix = model.get_vocab(with_added_tokens=False), getattr(model.model, "end_of_word_suffix", None)
    ends = np.zeros(max(vocab.values(), default=0) + 1, bool)
    ends[[i for t, i in vocab.items() if suffix and t.endswith(suffix)]] = True
    return model, ends


def parted(words: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Words of letters and only ASCII marks behind them: their letters in lower
    case, as the tokenizer reads them, and the marks.  Any other word as it is,
    and no marks.  Third: which words are the former."""
    fits = pc.match_substring_regex(words, f"^[{LETTERS}]+[{re.escape(MARKS)}]*$")
    core = pc.if_else(fits, pc.utf8_lower(pc.ascii_rtrim(words, MARKS)), words)
    mark = pc.if_else(fits, pc.utf8_ltrim(words, LETTER_SET), pa.scalar("", words.type))
    return core, mark, fits.to_numpy(zero_copy_only=False)


def spans(flat: np.ndarray, starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` numbered ``which`` (i goes from starts[i] up to
    starts[i + 1]), one after the other, and where each ends."""
    n = np.diff(starts)[which]
    ends = np.cumsum(n)
    return flat[np.repeat(starts[which] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)], ends


def _encoder(path: str, special_as_text: bool) -> WordEncoder:
    if (path, special_as_text) not in _ENCODERS:
        _ENCODERS[path, special_as_text] = WordEncoder(path, special_as_text)
    return _ENCODERS[path, special_as_text]


def _pieces(path: str, end_id: int, max_len: int, special_as_text: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(path, special_as_text)
        for pdf in batches:
            texts, at = pdf["text"].tolist(), 0
            while at < len(texts):  # about two million characters together
                to, chars = at, 0
                while to < len(texts) and (to == at or chars + len(texts[to]) <= 2_000_000):
                    chars += len(texts[to])
                    to += 1
                out = []
                for doc_id, ids in zip(pdf["doc_id"].iloc[at:to], encode(texts[at:to])):
                    ids += end
                    for s in range(0, len(ids), 4 * max_len):
                        piece = ids[s : s + 4 * max_len]
                        out.append((doc_id, s // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
                at = to
                yield pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        encode.trim()  # the worker lives on, also in jobs of another kind

    return run


def pack_histogram(hist: dict[int, int], max_len: int) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths) of each packing pattern.  Lengths go longest first,
    each into the patterns that are shortest so far and still have room."""
    room: dict[int, list[list]] = defaultdict(list)  # free tokens -> patterns
    for length in range(max_len, 0, -1):
        todo = hist.get(length, 0)
        while todo:
            free = max((f for f in room if f >= length and room[f]), default=0)
            if not free:
                room[max_len - length].append([todo, (length,)])
                break
            pattern = room[free][-1]
            took = min(todo, pattern[0])
            pattern[0] -= took
            grown = (*pattern[1], length)
            if not pattern[0]:
                room[free].pop()
                if not room[free]:
                    del room[free]
            room[free - length].append([took, grown])
            todo -= took
    return [(c, p) for f in sorted(room) for c, p in room[f]]


def pack(pieces: DataFrame, max_len: int) -> DataFrame:
    """Adds sequence_id and offset to pieces (at most max_len tokens each)."""
    spark = pieces.sparkSession
    buckets = max(16, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    sizes = cut_lineage(dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "length-buckets")
    hist = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most max_len rows

    slots, base, used = [], 0, defaultdict(int)
    for count, lengths in pack_histogram(hist, max_len):
        at = 0
        for length in lengths:
            slots.append((length, used[length], used[length] + count, base, at))
            used[length] += count
            at += length
        base += count
    # At most a few rows for each length and pattern, whatever the number of documents.
    per_length = defaultdict(list)
    for length, lo, hi, first, at in slots:
        per_length[length].append((lo, hi, first, at))
    slot_rows = [(n, s) for n, s in per_length.items()]
    kind = "length long, slots array<struct<lo:long,hi:long,first:long,at:long>>"
    slot_table = spark.createDataFrame(slot_rows, kind)

    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (
        dealt.withColumn("r", F.row_number().over(within) - 1)
        .join(offsets, ["length", "bucket"])
        .withColumn("rank", F.col("r") + F.col("ahead"))
    )
    return (
        ranked.join(F.broadcast(slot_table), "length")
        .withColumn("slot", F.expr("filter(slots, s -> rank >= s.lo and rank < s.hi)[0]"))
        .select(
            "doc_id",
            "start",
            "length",
            "ids_crc32",
            "doc_tokens",
            F.expr("slot.first + rank - slot.lo").alias("sequence_id"),
            F.expr("slot.at").alias("offset"),
        )
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, max_len: int = 2048, special_as_text: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one
    row per piece.  A whole sequence is a piece by itself."""
    pieces = cut_lineage(map_rows(id_text(docs), _pieces(tokenizer_path, end_id, max_len, special_as_text), PIECE), "pieces")
    return pack(pieces, max_len)
