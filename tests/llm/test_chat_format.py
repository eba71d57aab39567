"""Chat formatting: round trips, placeholders and digests."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tokenloom.llm import chat_format as C

BITS = st.lists(st.sampled_from(["\\", "\n", "<", "</turn>", "<turn>", "<part/>", "<image 0>", "### Assistant:", "turn>", "a", " ", "n", "é"]), max_size=8).map("".join)


def part(kind, text=None, ref=None, **sizes):
    return {"type": kind, "text": text, "ref": ref, "width": None, "height": None, "seconds": None, "pages": None} | sizes


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(BITS, st.lists(st.one_of(BITS, st.just(None)), min_size=1, max_size=4)), max_size=4))
def test_round_trip(turns):
    """Whatever roles and texts hold, a whole conversation reads back; None stands for an image."""
    formatted = [C.format_turn(r, [part("image", ref="i") if t is None else part("text", t) for t in ts], trained=(turns[0][0],)) for r, ts in turns]
    got = list(C.read_turns("".join(f[0] for f in formatted)))
    want = []
    for r, ts in turns:
        n = iter(range(9))
        want.append((r, [("image", str(next(n))) if t is None else ("text", t) for t in ts]))
    assert got == want
    for (r, ts), (text, loss, attachments, _) in zip(turns, formatted):
        under = [C.unescape(text[s["start"] : s["end"]]) for s in loss]
        assert under == ([t for t in ts if t is not None] if r == turns[0][0] else [])
        assert all(text[a["at"] :].startswith("<image ") for a in attachments)


def test_typed_parts():
    parts = [
        part("text", "look"),
        part("image", ref="s3://a.png", width=29, height=14),
        part("audio", ref="b.wav", seconds=1.5),
        part("document", ref="c.pdf", pages=2),
        part(None, "end\\"),
    ]
    text, loss, attachments, tokens = C.format_turn("user", parts)
    assert text == "<turn>user\nlook\n<part/>\n<image 0>\n<part/>\n<audio 1>\n<part/>\n<document 2>\n<part/>\nend\\\n</turn>\n"
    assert loss == [] and tokens == 3 + 38 + 2048
    assert [(a["kind"], a["ref"], a["tokens"]) for a in attachments] == [("image", "s3://a.png", 3), ("audio", "b.wav", 38), ("document", "c.pdf", 2048)]
    assert C.format_turn(None, None)[0] == "<turn>\n\n</turn>\n"
    with pytest.raises(ValueError):
        C.format_turn("user", [part("video")])


def digests(turns):
    every = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    formatted = sum(len(f"<turn>{C.write_role(r or '')}\n{C.escape(t or '')}\n</turn>\n") for r, t in turns)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (every, loss)]
    return len(turns), sha[0], len(loss), sha[1], formatted


def test_read_back(spark):
    big = (1 << 53) + 1
    rows = [(1, 1, "assistant", "fine </turn>"), (1, 0, "user", "how?"), (2, 0, None, None), (None, 0, "user", "no id"), (big, 0, "user", "a"), (big + 2, 0, "assistant", "é\\")]
    rows += [(3, 5, "assistant", "same")] * 2 + [(3, 5, "user", "tie"), (3, None, "user", "first")]
    rows += [(4, i, "user" if i % 2 == 0 else "assistant", "long " * 2000) for i in range(300)]
    df = spark.createDataFrame([(c, t, r, x, "clash", "clash") for c, t, r, x in rows], "conv_id long, turn long, role string, text string, out string, parts string").coalesce(1)
    got = {r.conv_id: tuple(r)[1:] for r in C.read_back(C.format_turns(df)).collect()}
    want: dict = {}
    for c, t, r, x in sorted(rows, key=lambda z: (z[1] is not None, z[1] or 0, z[2] or "", z[3] or "")):
        want.setdefault(c, []).append((r, x))
    assert got == {c: digests(ts) for c, ts in want.items()}
    assert C.read_back(C.format_turns(df.limit(0))).count() == 0
    probe = C.read_back(C.format_turns(C.with_probe(df.limit(0)))).collect()
    assert [tuple(r) for r in probe] == [(-7, *digests([("user", C.PROBE), ("assistant", C.PROBE)]))]


def test_content_column(spark):
    df = spark.createDataFrame([(1, 0, "assistant", [part("text", "x"), part("image", ref="r", width=28, height=28)], "clash")], f"conv_id long, turn long, role string, parts {C.PARTS}, row string")
    r = C.format_turns(df, content=df["parts"], patch=28).collect()[0]
    assert (r.formatted, r.expanded_tokens, r.attachments[0].ref, r.row.row) == ("<turn>assistant\nx\n<part/>\n<image 0>\n</turn>\n", 1, "r", "clash")
    assert [(s.start, s.end) for s in r.loss] == [(16, 17)]
