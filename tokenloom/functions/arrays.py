"""Array Column helpers (X18-X21) and stable renderings for comparisons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ints_str(col) -> Column:
    """An int array rendered ``"a,b,c"`` (DuckDB twin: ``array_to_string``)."""
    return F.array_join(F.transform(_c(col), lambda x: x.cast("string")), ",")


def ints_md5(col) -> Column:
    """md5 of :func:`ints_str`: a compact fingerprint of a long id array."""
    return F.md5(ints_str(col))


def last_n(col, n: int) -> Column:
    """The last ``n`` elements (``x[-n:]``), whole array when shorter."""
    c = _c(col)
    k = F.least(F.size(c), F.lit(n))
    return F.when(k > 0, F.slice(c, -k, k)).otherwise(F.slice(c, 1, 0))
