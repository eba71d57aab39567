"""Notices that are wrapped, or inside long lines and paragraphs."""

import random

import pytest

from tokenloom.llm import license_scan

NOTICES = {
    "gpl": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "lgpl": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "mit": "MIT License",
    "apache-2.0": """Licensed under the Apache
License, Version 2.0""",
    "bsd": """Redistribution and use in source and binary
forms, with or without modification, are
permitted""",
}


def prose(rnd, n):
    return " ".join(rnd.choice(["river", "stone", "the", "of", "light", "under", "day", "a", "and", "terms", "free"]) for _ in range(n))


@pytest.fixture(scope="module")
def scanned(spark):
    rnd = random.Random(2)
    rows, want = [(i, prose(rnd, 60) + "\n" + prose(rnd, 12)) for i in range(200, 300)], set()
    for n, (family, notice) in enumerate(NOTICES.items()):
        flat = " ".join(notice.split())
        rows += [
            (4 * n, prose(rnd, 30) + "\n\n" + notice + "\n\n" + prose(rnd, 30)),  # its own paragraph
            (4 * n + 1, prose(rnd, 30) + "\n" + notice.replace("\n", "\n * ") + "\n" + prose(rnd, 30)),  # lines of a longer one
            (4 * n + 2, prose(rnd, 150) + " " + flat + " " + prose(rnd, 150)),  # inside a long line
            (4 * n + 3, prose(rnd, 5) + "\n\n" + flat + ". " + prose(rnd, 40) + " " + flat),  # twice in one line
        ]
        want |= {(4 * n, 2, family), (4 * n + 1, 1, family), (4 * n + 2, 0, family), (4 * n + 3, 2, family)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return license_scan.license_scan(docs, license_scan.train(docs)).collect(), want


def test_finds_wrapped_and_embedded_notices(scanned):
    got, want = scanned
    assert {(r.doc_id, r.line, r.family) for r in got} == want
    assert len(got) == len(want) + len(NOTICES)  # the fourth documents have two each


def test_reports_the_lines_of_the_notice(scanned):
    got, _ = scanned
    for n, notice in enumerate(NOTICES.values()):
        assert [r.paragraph for r in got if r.doc_id == 4 * n] == [notice]
