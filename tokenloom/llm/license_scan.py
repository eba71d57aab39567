"""Licence scan: a trained paragraph classifier, confirmed by templates.

Multinomial logistic regression over hashed word n-grams (one and two words)
names a text's licence family or ``unknown``.  It learns from variants of
the templates and, for ``unknown``, from a bounded sample of corpus
passages; a temperature fitted on held-out rows calibrates it.  A prediction
stands when a passage in or around the classified words, no longer than a
template allows, has enough of the template's word n-grams.

A paragraph is a block of lines without a blank one, line breaks joined.  It is
classified in overlapping windows of words, and line by line.  Of passages that
overlap, the one most like its template is reported, joined with others of its
family, with the lines it is on.

Null or empty text has none that match; null ids are passed on; repeated rows
are reported each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import WordHash, id_text, map_rows, window_hashes

# Notices by which works name their licence, and the openings of the licences.
TEMPLATES = {
    "apache-2.0": [
        "licensed under the apache license, version 2.0",
        "you may not use this file except in compliance with the license",
        "apache license version 2.0, january 2004",
        "spdx-license-identifier: apache-2.0",
    ],
    "mit": [
        "released under the mit license",
        "licensed under the mit license",
        "mit license",
        "permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        "spdx-license-identifier: mit",
    ],
    "gpl": [
        "this work is licensed under the gnu general public license, version 3",
        "this program is free software: you can redistribute it and/or modify it under the terms of the gnu general public license",
        "under the terms of the gnu general public license as published by the free software foundation, either version 3 of the license, or (at your option) any later version",
        "you should have received a copy of the gnu general public license along with this program",
        "gnu general public license version 3, 29 june 2007",
        "spdx-license-identifier: gpl-3.0-or-later",
    ],
    "lgpl": [
        "licensed under the gnu lesser general public license, version 2.1",
        "this library is free software; you can redistribute it and/or modify it under the terms of the gnu lesser general public license",
        "under the terms of the gnu lesser general public license as published by the free software foundation, either version 2.1 of the license, or (at your option) any later version",
        "you should have received a copy of the gnu lesser general public license along with this library",
        "gnu lesser general public license version 2.1, february 1999",
        "spdx-license-identifier: lgpl-2.1-or-later",
    ],
    "bsd": [
        "redistribution and use in source and binary forms, with or without modification, are permitted",
        "redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "released under the bsd 3-clause license",
        "licensed under the bsd 3-clause license",
        "bsd 3-clause license",
        "bsd 2-clause license",
        "spdx-license-identifier: bsd-3-clause",
    ],
    "cc-by": ["licensed under cc by 4.0", "licensed under a creative commons attribution 4.0 international license"],
    "cc-by-nc": ["licensed under cc by-nc 4.0", "licensed under a creative commons attribution-noncommercial 4.0 international license"],
    "cc-by-sa": ["licensed under cc by-sa 4.0", "licensed under a creative commons attribution-sharealike 4.0 international license"],
    "mpl-2.0": [
        "this source code form is subject to the terms of the mozilla public license, v. 2.0",
        "if a copy of the mpl was not distributed with this file, you can obtain one at",
        "licensed under the mozilla public license, version 2.0",
        "mozilla public license version 2.0",
        "spdx-license-identifier: mpl-2.0",
    ],
    "proprietary": [
        "all rights reserved. no part may be reproduced without permission",
        "copyright, all rights reserved",
        "unauthorized copying of this file, via any medium, is strictly prohibited",
        "proprietary and confidential",
    ],
}
FAMILIES = ["unknown", *TEMPLATES]
DIMS = 1 << 16
WINDOW, STEP = 32, 16  # words; a notice of up to STEP words is whole in one window
_WORD = regex.compile(r"[\p{L}\p{N}]+(?:[.\-'][\p{L}\p{N}]+)*")


def gram_rows(words: list[str], memo: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """Hashed runs of one and of two words, by position."""
    h = memo.of([w.encode() for w in words])
    return tuple((window_hashes(h, n) >> np.uint64(48)).astype(np.int64) for n in (1, 2))


def grams(words: list[str], memo: WordHash) -> np.ndarray:
    """Distinct hashed runs of one and two words."""
    return np.unique(np.concatenate(gram_rows(words, memo)))


def tokens(line: str) -> list[str]:
    return _WORD.findall(line.lower())


def pairs(template: list[str]) -> set[tuple[str, str]]:
    return set(zip(template, template[1:]))


def passages(words: list[str], lo: int, hi: int, length: int, want: set, confirm: float) -> list[tuple[float, int, int, int]]:
    """(share of the template's two-word runs, their number, first word, end)
    of the passages of words[lo:hi] that have enough of them and are at most a
    quarter longer than the template."""
    at = [i for i in range(lo, hi - 1) if (words[i], words[i + 1]) in want]
    out, most = [], length + max(2, length // 4)
    for k, first in enumerate(at):
        seen, end = set(), first
        for i in at[k:]:
            if i + 2 - first > most:
                break
            if (words[i], words[i + 1]) not in seen:
                seen.add((words[i], words[i + 1]))
                end = i + 2
        if len(seen) / len(want) >= confirm:
            out.append((len(seen) / len(want), len(seen), first, end))
    return out


def blocks(text: str) -> Iterator[tuple[list[str], list[int]]]:
    """Words, and the line of each, of the blocks between blank lines."""
    words: list[str] = []
    line_of: list[int] = []
    for i, line in enumerate(text.split("\n")):
        if not line.strip():
            if words:
                yield words, line_of
            words, line_of = [], []
            continue
        ws = tokens(line)
        words += ws
        line_of += [i] * len(ws)
    if words:
        yield words, line_of


def spans(line_of: list[int]) -> list[tuple[int, int]]:
    """First word and end of each line and window of a block."""
    edge = np.flatnonzero(np.diff(line_of)) + 1
    out = set(zip([0, *edge.tolist()], [*edge.tolist(), len(line_of)]))
    last = max(0, len(line_of) - WINDOW)
    out.update((a, min(len(line_of), a + WINDOW)) for a in [*range(0, last, STEP), last])
    return sorted(out)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class ParagraphClassifier:
    def __init__(self):
        self.w, self.b, self.heat = np.zeros((DIMS, len(FAMILIES))), np.zeros(len(FAMILIES)), 1.0

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        flat = np.concatenate(rows)
        starts = np.concatenate(([0], np.cumsum([len(r) for r in rows])[:-1])).astype(np.int64)
        size = np.sqrt(np.array([len(r) for r in rows]))[:, None]
        return (np.add.reduceat(self.w[flat], starts, axis=0) / size + self.b) / self.heat

    def fit(self, rows: list[np.ndarray], y: np.ndarray, epochs: int = 30, rate: float = 0.5, seed: int = 1) -> "ParagraphClassifier":
        rng = np.random.default_rng(seed)
        held = rng.random(len(y)) < 0.2
        train, square = np.flatnonzero(~held), np.full(DIMS, 1e-6)
        for _ in range(epochs):
            for pick in np.array_split(rng.permutation(train), max(1, len(train) // 64)):
                part = [rows[i] for i in pick]
                err = softmax(self.logits(part))
                err[np.arange(len(pick)), y[pick]] -= 1
                for r, g in zip(part, err):
                    square[r] += (g**2).sum() / len(r)
                    self.w[r] -= rate * g / np.sqrt(len(r)) / np.sqrt(square[r])[:, None]
                self.b -= 0.05 * err.mean(axis=0)
        if held.any():
            z, target = self.logits([rows[i] for i in np.flatnonzero(held)]), y[held]
            heats = np.geomspace(0.25, 4, 17)
            loss = [-np.log(softmax(z / t)[np.arange(len(target)), target] + 1e-12).mean() for t in heats]
            self.heat = float(heats[int(np.argmin(loss))])
        return self


def template_variants(copies: int, filler: list[list[str]], rng) -> list[tuple[int, list[str]]]:
    """Template words with some dropped, parts of long ones, and other words
    around them up to a window."""
    out = []
    for family, texts in TEMPLATES.items():
        for text in texts:
            for i in range(copies):
                ws = [w for w in tokens(text) if i == 0 or rng.random() > 0.1]
                if i % 4 == 3 and len(ws) > STEP:
                    at = rng.integers(len(ws) - STEP + 1)
                    ws = ws[at : at + STEP]
                if i % 4 and filler:
                    room = max(0, WINDOW - len(ws)) if i % 4 == 1 else rng.integers(max(1, WINDOW - len(ws)))
                    before = rng.integers(room + 1)
                    head, tail = (filler[rng.integers(len(filler))] for _ in range(2))
                    ws = [*head[len(head) - min(before, len(head)) :], *ws, *tail[: room - before]]
                out.append((FAMILIES.index(family), ws))
    return out


def train(docs: DataFrame, sample: int = 4000) -> ParagraphClassifier:
    """Fits on template variants and, from at most ``sample`` documents, a line
    and a window each that have less than a third of every template."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wants = [(len(tokens(t)), pairs(tokens(t))) for ts in TEMPLATES.values() for t in ts]
        known = set().union(*(w for _, w in wants))
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                found = list(blocks(text))
                if not found:
                    continue
                ws, line_of = found[-1]
                a = max(0, len(ws) // 2 - WINDOW // 2)
                for unit in ([w for w, n in zip(ws, line_of) if n == line_of[-1]], ws[a : a + WINDOW]):
                    like = known & pairs(unit) and any(passages(unit, 0, len(unit), n, want, 1 / 3) for n, want in wants)
                    if not like:
                        out.append(" ".join(unit))
            yield pd.DataFrame({"line": out})

    some = id_text(docs).orderBy(F.xxhash64("doc_id")).limit(sample).select("text")
    filler = [r["line"].split() for r in some.mapInPandas(run, "line string").collect()]
    rng, memo = np.random.default_rng(1), WordHash()
    rows = template_variants(40, filler, rng) + [(0, ws) for ws in filler]
    rows = [(y, g) for y, ws in rows if len(g := grams(ws, memo))]
    return ParagraphClassifier().fit([g for _, g in rows], np.array([y for y, _ in rows]))


def notices(words: list[str], line_of: list[int], m: ParagraphClassifier, memo: WordHash, templates: dict, confirm: float):
    """(line, last line, family, probability, similarity) of a block's notices."""
    one, two = gram_rows(words, memo)
    units, found = spans(line_of), {}
    for lo in range(0, len(units), 256):
        here = units[lo : lo + 256]
        p = softmax(m.logits([np.unique(np.concatenate((one[a:b], two[a : b - 1]))) for a, b in here]))
        for (a, b), best, row in zip(here, p.argmax(axis=1), p):
            if best:
                for length, want in templates[FAMILIES[best]]:
                    for like, n, first, end in passages(words, max(0, a - length), min(len(words), b + length), length, want, confirm):
                        if first < b and end > a:
                            key = (first, end, FAMILIES[best])
                            found[key] = max(found.get(key, (0, 0, 0)), (like, n, float(row[best])))
    out: list[list] = []  # first word, end, family, probability, similarity; passages of one family that overlap join
    for (first, end, family), (like, _, prob) in sorted(found.items(), key=lambda x: ([-v for v in x[1]], x[0])):
        over = [n for n in out if first < n[1] and end > n[0]]
        if not over:
            out.append([first, end, family, prob, like])
        elif len(over) == 1 and over[0][2] == family:
            over[0][:2] = min(first, over[0][0]), max(end, over[0][1])
    for first, end, *rest in sorted(out):
        yield line_of[first], line_of[end - 1], *rest


def license_scan(docs: DataFrame, model: ParagraphClassifier, confirm: float = 0.6) -> DataFrame:
    """doc_id, line (number from 0, the first of the notice), family,
    probability, similarity, paragraph (the notice's lines): the passages whose
    predicted family a template confirms."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, memo = shared.value, WordHash()
        templates = {f: [(len(tokens(t)), pairs(tokens(t))) for t in ts] for f, ts in TEMPLATES.items()}
        for pdf in batches:
            out = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                lines = text.split("\n")
                for words, line_of in blocks(text):
                    for first, last, *rest in notices(words, line_of, m, memo, templates, confirm):
                        out.append((doc_id, first, *rest, "\n".join(lines[first : last + 1])))
            yield pd.DataFrame(out, columns=["doc_id", "line", "family", "probability", "similarity", "paragraph"])

    return map_rows(id_text(docs), run, "doc_id long, line int, family string, probability double, similarity double, paragraph string")
