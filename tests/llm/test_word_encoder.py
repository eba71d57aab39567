"""Ids by distinct words equal the plain tokenizers call on whole texts."""

import os
import random

import numpy as np
import public_tokenizers as P
import pytest

from tokenloom.llm import packing

PATH = P.path("word_bpe_49k.json")


def plain(texts):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def by_words(texts, encoder=None):
    encode = encoder or packing.WordEncoder(PATH, False)
    return [np.frombuffer(b, "<u4").tolist() for b in encode(texts)]


def test_odd_texts():
    rnd = random.Random(7)
    bits = ["a", "B", "é", "é", "́", "ͅ", "Σ", "ΑΣ", "ς", "İ", "ß", "ǅ", "ﬁ", "日本", "9", "١", "'s", "'LL", "’s", "--", "<|endoftext|>", "<|startoftext|>", "<|end", "‍", "\U0001f600"]
    spaces = [" ", "\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", " ", "　", " ", "​", "﻿", "", "", ""]
    texts = ["", " ", "\x00", *["".join(rnd.choice(bits) + rnd.choice(spaces) for _ in range(rnd.randint(1, 25))) for _ in range(3000)]]
    assert by_words(texts) == plain(texts)


def test_a_full_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(packing, "WORDS_KEPT", 3)
    encode = packing.WordEncoder(PATH, False)
    texts = [f"one two w{i} three" for i in range(20)]
    assert [by_words([t], encode)[0] for t in texts] == plain(texts)


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01/documents.parquet"), reason="needs the given tables")
def test_every_document():
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    assert by_words(texts) == plain(texts)


def test_every_letter_encoded_with_others():
    letters = [chr(c) for c in range(0x250)]
    ends = ["", *".,;:!?", "'", "..", "́"]
    texts = [" ".join(f"{a}{x}{b}{e}" for e in ends for a, b in (("", ""), ("a", "Z"), ("ß", "."))) for x in letters if not x.isspace()]
    assert by_words(texts) == plain(texts)


def test_words_of_letters_share_calls(monkeypatch):
    """Thousands of new words took a call of the whole tokenizer each."""
    encode, alone = packing.WordEncoder(PATH, False), []
    whole = packing._tokenizer(PATH)

    class Counted:
        def encode_batch_fast(self, texts, **kw):
            alone.extend(texts)
            return whole.encode_batch_fast(texts, **kw)

        model = whole.model

    monkeypatch.setattr(packing, "_tokenizer", lambda path: Counted())
    rnd = random.Random(3)
    texts = [" ".join("".join(rnd.choices("abcdeABCDEéÖ", k=7)) + rnd.choice([".", "", "!"]) for _ in range(500)) for _ in range(10)]
    assert by_words(texts, encode) == plain(texts)
    assert len(alone) <= 6  # the marks


def test_a_task_leaves_few_words_to_its_worker(monkeypatch):
    """Workers kept up to 2^20 words after the task, beside the next jobs' tasks."""
    import pandas as pd

    monkeypatch.setattr(packing, "WORDS_STAY", 50)
    monkeypatch.setattr(packing, "_ENCODERS", {})
    pdf = pd.DataFrame({"doc_id": ["1", "2"], "text": [" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)), "one two"]})
    assert sum(len(p) for p in packing._pieces(PATH, 1, 2048, False)(iter([pdf]))) == 2
    assert max(len(e.known) for e in packing._ENCODERS.values()) <= 50


def test_words_before_several_marks_share_calls(monkeypatch):
    """Each word with two marks or more behind it went through the whole tokenizer."""
    encode, alone = packing.WordEncoder(PATH, False), []
    whole = packing._tokenizer(PATH)

    class Counted:
        def encode_batch_fast(self, texts, **kw):
            alone.extend(texts)
            return whole.encode_batch_fast(texts, **kw)

        model = whole.model

    monkeypatch.setattr(packing, "_tokenizer", lambda path: Counted())
    rnd = random.Random(4)
    marks = ["&&&", ".***", "!!", "'", "''", "<|", "...", "_$", ""]
    texts = [" ".join("".join(rnd.choices("abcdeABCDEéÖſŉ", k=7)) + rnd.choice(marks) for _ in range(500)) for _ in range(10)]
    texts += ["a<|endoftext|>", "b'<|endoftext|>..", "don't's''", "x" + "!" * 300]
    assert by_words(texts, encode) == plain(texts)
    assert len(alone) <= len(marks) + 4


def test_spaces_and_null_signs_around_words():
    texts = ["", " ", "\x0b\x0ca \x0b b\t", "a\x1cb", "a\x85b", "a\x00b", "\ud800 a", " a" * 5]
    want = [np.frombuffer(b, "<u4").tolist() for b in packing.WordEncoder(PATH, False)(texts)]
    assert want == plain([t.encode("utf-8", "replace").decode() for t in texts])
