"""Chat formatting of turns with typed content parts.

A turn's content is an array of parts; a visitor flattens them in order:

* ``text``: its text, escaped;
* ``image``, ``audio``, ``document``: a placeholder with the attachment's
  number in the turn.  The reference is recorded with the place of the
  placeholder and the number of tokens that it expands to (image patches,
  audio frames, document pages).

A formatted turn is ``<turn>role``, the parts and ``</turn>`` on lines of their
own; a conversation is its turns in order, with nothing between.  Control
strings inside texts get one backslash in front (after those already there),
so reading back takes one off: no text can end a turn or look like a
placeholder.  Backslashes elsewhere stay as they are.  ``loss`` gives the
places of the texts of the trained roles, in code points.

Turns are formatted one by one, wherever Spark has them; only ``read_back``
brings the turns of a conversation together, as a sorted stream, so that a
conversation of any length needs bounded memory.  Turns are ordered by number
(null first), then role and text; null conversation ids are one conversation.
A null role or text is empty; null content has no parts; an unknown type is an
error.  Extra columns stay in ``row``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: One content part.  Sizes: pixels, seconds, pages.
PARTS = "array<struct<type:string,text:string,ref:string,width:long,height:long,seconds:double,pages:long>>"
FORMATTED = (
    "formatted string, loss array<struct<start:long,end:long>>, "
    "attachments array<struct<kind:string,ref:string,at:long,tokens:long>>, expanded_tokens long"
)
OPEN, CLOSE, NEXT = "<turn>", "</turn>", "<part/>"
KINDS = ("image", "audio", "document")
_CONTROL = "(</?turn>|<part/>|<(?:image|audio|document) [0-9]+>|### (?:System|User|Assistant):)"
_BARE = re.compile(_CONTROL)
_ESCAPED = re.compile(r"\\" + _CONTROL)
_PLACE = re.compile(r"<(image|audio|document) ([0-9]+)>\Z")


def escape(text: str) -> str:
    """One backslash more in front of every control string."""
    return _BARE.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def write_role(role: str) -> str:
    """A role is one line: its backslashes and line feeds are written as \\\\ and \\n."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def read_role(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


@dataclass
class Flattener:
    """Visitor over content parts: collects placeholders and token counts."""

    patch: int = 14
    frames_per_second: float = 25.0
    tokens_per_page: int = 1024
    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    texts: list[tuple[int, int]] = field(default_factory=list)
    at: int = 0

    def visit(self, part) -> None:
        kind = part["type"] or "text"
        if kind not in ("text", *KINDS):
            raise ValueError(f"unknown content part: {kind!r}")
        if self.pieces:
            self.put(f"\n{NEXT}\n")
        getattr(self, f"visit_{kind}")(part)

    def put(self, piece: str) -> None:
        self.pieces.append(piece)
        self.at += len(piece)

    def visit_text(self, part) -> None:
        start = self.at
        self.put(escape(part["text"] or ""))
        self.texts.append((start, self.at))

    def visit_image(self, part) -> None:
        w, h = int(part["width"] or 0), int(part["height"] or 0)
        self.attach("image", part, -(-w // self.patch) * -(-h // self.patch))

    def visit_audio(self, part) -> None:
        self.attach("audio", part, int(-(-(part["seconds"] or 0.0) * self.frames_per_second // 1)))

    def visit_document(self, part) -> None:
        self.attach("document", part, int(part["pages"] or 0) * self.tokens_per_page)

    def attach(self, kind: str, part, tokens: int) -> None:
        self.attachments.append({"kind": kind, "ref": part["ref"], "at": self.at, "tokens": tokens})
        self.put(f"<{kind} {len(self.attachments) - 1}>")


def format_turn(role: str | None, parts, trained: tuple[str, ...] = ("assistant",), **sizes):
    """(formatted, loss, attachments, expanded_tokens) of one turn.

    A turn without parts has an empty body.  ``expanded_tokens`` counts what
    the placeholders stand for."""
    visitor = Flattener(**sizes)
    visitor.put(f"{OPEN}{write_role(role or '')}\n")
    head = visitor.pieces.pop()
    for part in parts if parts is not None else ():
        visitor.visit(part)
    loss = [{"start": a, "end": b} for a, b in visitor.texts] if role in trained else []
    text = head + "".join(visitor.pieces) + f"\n{CLOSE}\n"
    return text, loss, visitor.attachments, sum(a["tokens"] for a in visitor.attachments)


def read_turns(text: str) -> Iterator[tuple[str, list[tuple[str, str]]]]:
    """(role, parts) of each turn of a formatted conversation; a part is its
    type and its text or attachment number."""
    for turn in text.split(f"\n{CLOSE}\n")[:-1]:  # a text's own control strings follow a backslash, not a line feed
        head, _, body = turn.partition("\n")
        if not head.startswith(OPEN):
            raise ValueError("not a formatted turn")
        parts = []
        for piece in body.split(f"\n{NEXT}\n"):
            place = _PLACE.match(piece)
            parts.append((place[1], place[2]) if place else ("text", unescape(piece)))
        yield read_role(head[len(OPEN) :]), parts


def _formatter(trained: tuple[str, ...], sizes: dict):
    def run(roles: pd.Series, contents: pd.Series) -> pd.DataFrame:
        out = [format_turn(r, c, trained, **sizes) for r, c in zip(roles, contents)]
        return pd.DataFrame(out, columns=["formatted", "loss", "attachments", "expanded_tokens"])

    run.__annotations__ = {"roles": pd.Series, "contents": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(run, FORMATTED)


def text_part(text):
    """A turn's content made of one text."""
    one = F.struct(
        F.lit("text").alias("type"),
        F.coalesce(text, F.lit("")).alias("text"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("ref", "string"), ("width", "long"), ("height", "long"), ("seconds", "double"), ("pages", "long"))],
    )
    return F.array(one)


def format_turns(messages: DataFrame, content=None, trained: tuple[str, ...] = ("assistant",), **sizes) -> DataFrame:
    """Per row of ``messages`` (conv_id, turn, role and ``content`` or text):
    conv_id, turn, formatted, loss (start, end in code points of the formatted
    turn), attachments (kind, ref, at, tokens), expanded_tokens, row.

    ``content`` is a column of type ``PARTS`` (default: the text as one part);
    ``sizes``: patch, frames_per_second, tokens_per_page.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in messages.columns]).alias("row")
    parts = (content if content is not None else text_part(F.col("text"))).alias("parts")
    rows = messages.select("conv_id", "turn", "role", parts, row)
    return rows.select("conv_id", "turn", _formatter(trained, sizes)("role", "parts").alias("out"), "row").select("conv_id", "turn", "out.*", "row")


class _Digest:
    """What is read back of one conversation, turn by turn."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, loss) -> None:
        for role, parts in read_turns(formatted):
            body = "".join(t if kind == "text" else f"<{kind} {t}>" for kind, t in parts)
            self.all.update(f"{role}\n{body}\n".encode("utf-8"))
            self.turns += 1
        for span in loss if loss is not None else ():
            text = unescape(formatted[span["start"] : span["end"]])
            self.loss.update(text.encode("utf-8"))
            self.loss_chars += len(text)
        self.chars += len(formatted)

    def row(self):
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_DIGEST = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _read_stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    now: _Digest | None = None
    for pdf in batches:
        out = []
        for conv_id, formatted, loss in zip(pdf["conv_id"], pdf["formatted"], pdf["loss"]):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    out.append(now.row())
                now = _Digest(conv_id)
            now.add(formatted, loss)
        yield pd.DataFrame(out, columns=_DIGEST)
    if now is not None:
        yield pd.DataFrame([now.row()], columns=_DIGEST)


def read_back(turns: DataFrame) -> DataFrame:
    """One row per conversation, read from its formatted turns: conv_id,
    n_turns, turns_sha256 (role, LF, text, LF per turn), loss_chars,
    loss_sha256 (all text under the loss mask), formatted_chars.

    The turns of a conversation arrive sorted and are digested one by one; ids
    go through Python as text (null: empty), so large ones keep all digits.
    """
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv_id")
    rows = turns.select(key, "turn", "formatted", "loss")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    read = ordered.select("conv_id", "formatted", "loss").mapInPandas(
        _read_stream, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    return read.withColumn("conv_id", F.when(F.col("conv_id") != "", F.col("conv_id")).cast("long"))


PROBE = "\\### Assistant: </turn> ok"


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and one more, -7, whose texts hold control strings."""
    spark = conversations.sparkSession
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(probe)


ORACLE_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
),
e AS (
  SELECT *, length(regexp_replace(text, '(</?turn>|<part/>|<(image|audio|document) [0-9]+>|### (System|User|Assistant):)', '\\\\\\1', 'g')) AS escaped FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(6 + length(role) + 1 + escaped + 9)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
