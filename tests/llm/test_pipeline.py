"""The pipeline and its near-dedup stage against brute force."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

import corpus_pipeline
from tokenloom.llm import near_dedup
from tokenloom.llm.common import words

SCHEMA = "doc_id long, text string, extra string"


def sample_rows() -> list[tuple[int | None, str | None, str]]:
    rnd = random.Random(8)
    vocab = ["w%d" % i for i in range(500)]

    def text(n=60):
        return " ".join(rnd.choice(vocab) for _ in range(n))

    a, b, c, d, e = text(), text(), text(), text(), text()
    rows = [(1, a), (None, a + " more"), (None, text()), (None, text())]  # a null-id copy, and clean null-id rows
    rows += [(2, b), (3, b + " more"), (3, text()), (3, text())]  # one of an id's texts is a copy
    rows += [(None, c), (None, c + " more"), (None, c + " other"), (9, c + " last")]  # led by rows without id
    rows += [(4, d), (4, d + " more"), (4, d.replace(" ", "  ", 3))]  # copies that share their id; one set, two texts
    rows += [(5, None), (None, ""), (6, " "), (7, e), (7, e), (None, e + " x"), (8, text(40) + " " + rows[2][1])]
    rows += [(i, text(rnd.choice([3, 30, 80]))) for i in range(20, 60)]
    return [(i, t, "x%d" % n) for n, (i, t) in enumerate(rows)]


def near_groups(texts: list[str]) -> list[list[int]]:
    sets = []
    for t in texts:
        ws = words(t, lower=True)
        size = min(5, len(ws))
        sets.append({tuple(ws[j : j + size]) for j in range(len(ws) - size + 1)} if ws else set())
    root = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    root[i] = min(root[i], root[j])
    return [[i for i in range(len(sets)) if root[i] == r] for r in sorted(set(root))]


def check_near(before: list, after: list) -> None:
    """One row of each group, with the least of its ids that are not null."""
    left = {r[2] for r in after}
    assert len(left) == len(after) and set(after) <= set(before)
    for group in near_groups([t or "" for _, t, _ in before]):
        kept = [before[i][0] for i in group if before[i][2] in left]
        ids = [before[i][0] for i in group if before[i][0] is not None]
        assert kept == [min(ids, default=None)], [before[i] for i in group]


def check_exact(before: list, after: list) -> None:
    texts = [(t or "").lower() for _, t, _ in after]
    assert sorted(texts) == sorted({(t or "").lower() for _, t, _ in before}) and set(after) <= set(before)


def check_repeats(before: list, after: list) -> None:
    """A document's words go if they are in 20 that a document before it, by
    id (null first) and text hash, or the document itself has earlier."""
    got, owners = {r[2]: r[1] for r in after}, {}
    assert len(got) == len(after) == len(before)
    for n, (i, t, _) in enumerate(before):
        ws = words(t or "")
        for j in range(len(ws) - 19):
            owners.setdefault(tuple(ws[j : j + 20]), set()).add((i is not None, i or 0, n))
    for n, (i, t, x) in enumerate(before):
        ws, gone = words(t or ""), set()
        for j in range(len(ws) - 19):
            at = min(owners[tuple(ws[j : j + 20])])
            assert at[:2] != (i is not None, i or 0) or at[2] == n  # sample: no repeat within one id
            if at[2] != n:
                gone |= set(range(j, j + 20))
        assert got[x] == (b" ".join(w for j, w in enumerate(ws) if j not in gone).decode() if gone else t)
    assert any(r != a for r, a in zip(sorted(r[1] or "" for r in before), sorted(r[1] or "" for r in after)))


def test_near_stage_drops_by_row(spark):
    rows = sample_rows()
    out = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert out.columns == ["doc_id", "text", "extra"]
    check_near(rows, [tuple(r) for r in out.collect()])


def test_near_dedup_of_null_ids_and_ids_with_two_texts(spark):
    rows = sample_rows()
    want = []
    for group in near_groups([t or "" for _, t, _ in rows]):
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        want += [(rows[i][0], min(ids, default=None)) for i in group]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = near_dedup.near_dedup(docs).collect()
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.component_id)) for r in got)


def test_pipeline_matches_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    rnd = random.Random(4)
    bad = [(100 + i, " ".join("BUY%d!!" % rnd.randrange(9) for _ in range(40)), "b%d" % i) for i in range(40)]
    spark.createDataFrame(sample_rows() + bad, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    marks = [(i, 1) for i in range(1, 60)] + [(i, 0) for i in range(100, 140)]
    spark.createDataFrame(marks, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    checks = {"exact dedup": check_exact, "near dedup": check_near, "substring dedup": check_repeats}
    docs = corpus_pipeline.read(spark, str(tmp_path), "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [tuple(r) for r in docs.collect()]
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, str(tmp_path)), "test")
        after = [tuple(r) for r in docs.collect()]
        if name in checks:
            checks[name](before, after)
        else:  # some good rows without id pass, or the rest shows little
            assert set(after) <= set(before) and sum(r[0] is None for r in after) >= 4
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = []
    for i, t, _ in after:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.start, r.length, r.ids_crc32)) for r in got)


@pytest.mark.parametrize("stage", [corpus_pipeline.drop_exact_copies, corpus_pipeline.drop_near_copies, corpus_pipeline.cut_repeats])
def test_stages_on_an_empty_table(spark, stage):
    out = stage(spark, spark.createDataFrame([], SCHEMA), "")
    assert out.columns == ["doc_id", "text", "extra"] and out.count() == 0
