"""String Column expressions (X1-X11 of the inventory).

All expressions are built-in Spark functions, so they stay inside whole-stage
codegen and run JVM-side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Code points Python's str.strip()/str.split() treat as white space
# (str.isspace): ASCII \t \n \v \f \r and space, the separators U+001C-U+001F,
# U+0085, U+00A0, U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
# Written once in a syntax both Java regex and RE2 (DuckDB) accept.
PY_WHITESPACE_CLASS = (
    "[\\t\\n\\x0B\\f\\r \\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)
# The same set as a string of characters, for ``btrim``.
PY_WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Java regex for one run of that set: (?U) makes \s the Unicode White_Space
# property, plus the four separators U+001C-U+001F.
PY_WHITESPACE_RUN_JAVA = "(?U)[\\s\\x{1C}-\\x{1F}]+"
# Kana and CJK ideographs: U+3040-U+30FF, U+3400-U+4DBF, U+4E00-U+9FFF.
JA_SCRIPT_CLASS = "[\\x{3040}-\\x{30FF}\\x{3400}-\\x{4DBF}\\x{4E00}-\\x{9FFF}]"
# Sentence marks used by the reference corpora.
EN_SENTENCE_DELIM = ". "
JA_SENTENCE_DELIM = "。 "
JA_COUNT_DELIM = "。"
EN_COUNT_DELIM = "."
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col) -> Column:
    """Python ``str.strip()`` (Unicode white space at both ends).

    Spark's one-argument ``trim`` only removes U+0020; ``btrim`` with the
    explicit character set is a linear scan from both ends (a regex anchored
    at the end would be retried at every white-space run)."""
    return F.btrim(_c(col), F.lit(PY_WHITESPACE_CHARS))


def has_non_space(col) -> Column:
    """True when the text has a character that is not white space
    (Python ``bool(t.strip())``)."""
    return _c(col).rlike("[^" + PY_WHITESPACE_CLASS[1:-1] + "]")


def split_literal(col, delim: str) -> Column:
    """``str.split(delim)``: literal delimiter, trailing empties kept."""
    import re

    return F.split(_c(col), re.escape(delim), -1)


def count_literal(col, delim: str) -> Column:
    """``str.count(delim)``: non-overlapping occurrences of a literal."""
    c = _c(col)
    removed = F.length(c) - F.length(F.replace(c, F.lit(delim), F.lit("")))
    return (removed / F.lit(len(delim))).cast("long")


def whitespace_words(col) -> Column:
    """``str.split()``: runs of white space separate words, no empty words."""
    return F.filter(F.split(_c(col), PY_WHITESPACE_RUN_JAVA, -1), lambda w: w != F.lit(""))


def has_script(col, char_class: str = JA_SCRIPT_CLASS) -> Column:
    """Any code point of the class (kana / CJK by default)."""
    return F.coalesce(_c(col).rlike(char_class), F.lit(False))


def char_len(col) -> Column:
    """Code points (Python ``len``)."""
    return F.char_length(_c(col)).cast("long")


def byte_len(col) -> Column:
    """UTF-8 bytes (``len(s.encode('utf-8'))``)."""
    return F.octet_length(_c(col)).cast("long")


def step_suffix(col, sep: str = "-") -> Column:
    """Last ``sep``-separated part as a number (``int(x.split('-')[-1])``)."""
    import re

    return F.try_element_at(F.split(_c(col), re.escape(sep), -1), F.lit(-1)).try_cast("long")


def zero_padded(n, width: int = 7) -> Column:
    """``f"{n:07d}"``."""
    return F.format_string(f"%0{width}d", _c(n))


def preview(col, n: int = 120) -> Column:
    """X11: display prefix of a string."""
    return F.substring(_c(col), 1, n)


def has_prefix(col, prefix: str) -> Column:
    """``name.startswith(prefix)``."""
    return _c(col).startswith(prefix)


def has_suffix(col, suffix: str) -> Column:
    """``name.endswith(suffix)``."""
    return _c(col).endswith(suffix)
