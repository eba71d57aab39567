"""Line dedup, all in DataFrame functions.

Line hashes are range-partitioned with a secondary sort by document; the
first line of each document in a key's run is streamed out and counted.
What comes back to a document is a bitmap of its dropped lines, not text.

Null or empty text is one empty line.  Rows that repeat doc_id and text count
as one document; null ids are ids like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import LOWER, UPPER, doc_key, id_text
from tokenloom.session import cut_lineage

SPACES = " \t\n\x0b\x0c\r"


def line_hits(docs: DataFrame, min_code_points: int) -> DataFrame:
    """One row per (line key, document): h1, h2 (128 bits), doc_id, th and the
    positions of the key's lines as 64-bit words, ``bits`` (word, mask)."""
    lines = docs.select("doc_id", "th", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit(SPACES)), UPPER, LOWER)
    return (
        lines.withColumn("key", key)
        .where(F.length("key") >= min_code_points)
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "th", "pos")
    )


def dropped_lines(docs: DataFrame, min_docs: int = 10, min_code_points: int = 1) -> DataFrame:
    """doc_id, th and ``words`` (map from position div 64 to a 64-bit mask of
    dropped lines), for documents that lose lines."""
    # Read three times (range bounds, range exchange, join back): split and hash once.
    hits = cut_lineage(line_hits(docs, min_code_points), "line-hits")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = hits.repartitionByRange(parts, "h1", "h2", "doc_id", "th").sortWithinPartitions("h1", "h2", "doc_id", "th", "pos")
    # All lines of one key in one document are in one range, so this needs no
    # further shuffle; counting documents per key then folds before shuffling.
    first = ordered.groupBy("h1", "h2", "doc_id", "th").agg(F.min("pos").alias("pos"))
    often = cut_lineage(
        first.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= min_docs).select("h1", "h2"),
        "line-keys",
    )
    lost = hits.join(often, ["h1", "h2"]).select(
        "doc_id", "th", F.expr("pos div 64").alias("w"), F.expr("shiftleft(1L, pos % 64)").alias("bit")
    )
    return (
        lost.groupBy("doc_id", "th", "w")
        .agg(F.bit_or("bit").alias("mask"))
        .groupBy("doc_id", "th")
        .agg(F.map_from_entries(F.collect_list(F.struct("w", "mask"))).alias("words"))
    )


def line_dedup(docs: DataFrame, min_docs: int = 10, min_code_points: int = 1) -> DataFrame:
    """doc_id, text (what stays), n_lines, n_dropped."""
    base = id_text(docs).withColumn("th", doc_key())
    lost = cut_lineage(dropped_lines(base, min_docs, min_code_points), "line-bitmaps")
    d, x = base.alias("d"), lost.alias("x")
    joined = d.join(x, (F.col("d.th") == F.col("x.th")) & F.col("d.doc_id").eqNullSafe(F.col("x.doc_id")), "left").select("d.doc_id", "d.text", "x.words")
    kept = F.expr(
        "filter(split(text, '\\n', -1), (l, i) -> shiftright(coalesce(element_at(words, i div 64L), 0L), i % 64) & 1L = 0)"
    )
    return joined.withColumn("kept", F.when(F.col("words").isNull(), F.split("text", "\n", -1)).otherwise(kept)).select(
        "doc_id",
        F.array_join("kept", "\n").alias("text"),
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        (F.size(F.split("text", "\n", -1)) - F.size("kept")).cast("long").alias("n_dropped"),
    )


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT doc_id, pos, line,
             translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
