"""Scans and sources.

Corpora are DataFrames ``(id, text, ...)``.  Scans read parquet / json /
text through ``spark.read`` so Catalyst prunes columns and pushes filters
into the reader; order is an explicit column, never file order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.functions import text as T


def spread_small(df: DataFrame) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster's default
    parallelism (a small input, e.g. one parquet row group) over all cores,
    so per-record work (strip, augment, word split) is not single-threaded.
    Only in sessions that ask for it (``tokenloom.spreadSmallScans``; local
    tests and bench), as it is a full shuffle; elsewhere the reader's split
    size decides.  Results never depend on partitioning."""
    spark = df.sparkSession
    if spark.conf.get("tokenloom.spreadSmallScans", "false") != "true":
        return df
    target = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def scan_corpus(spark: SparkSession, path: str, text_col: str = "text", id_col: str | None = "doc_id",
                fmt: str = "parquet", out_text: str = "text") -> DataFrame:
    """Load a corpus as ``(id, text)``; an absent text field reads as
    ``""`` (the reference's ``item.get("text", "")``), null as well."""
    df = spread_small(spark.read.format(fmt).load(path))
    txt = F.coalesce(F.col(text_col), F.lit("")) if text_col in df.columns else F.lit("")
    cols = ([F.col(id_col)] if id_col else []) + [txt.alias(out_text)]
    return df.select(*cols)


def scan_splits(frames: dict, spec: str = "train+validation", id_col: str = "doc_id") -> DataFrame:
    """Several splits read as one, in the order named by ``spec``
    (``"train+validation"``); adds ``split`` and ``split_rank``."""
    names = [s.strip() for s in spec.split("+") if s.strip()]
    out = None
    for rank, name in enumerate(names):
        d = frames[name].withColumn("split", F.lit(name)).withColumn("split_rank", F.lit(rank))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def concat_corpora(frames, source_col: str = "source_name") -> DataFrame:
    """Append corpora (no dedup); a single input passes through.
    ``frames`` is ``[(name, df), ...]``; each row is tagged with its corpus
    and its corpus rank (order of concatenation)."""
    frames = list(frames)
    if len(frames) == 1:
        return frames[0][1]
    out = None
    for rank, (name, df) in enumerate(frames):
        d = df.withColumn(source_col, F.lit(name)).withColumn("source_rank", F.lit(rank))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def union_all(frames) -> DataFrame:
    """Plain ``UNION ALL`` by column name."""
    frames = list(frames)
    out = frames[0]
    for d in frames[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def scan_lines(df: DataFrame, key: str = "doc_id", col: str = "text") -> DataFrame:
    """Lines of each record, stripped, blanks dropped, original 0-based
    line number kept: ``(key, line_no, line)``."""
    ex = df.select(key, F.posexplode(F.split(F.col(col), "\n", -1)).alias("line_no", "_raw"))
    ex = ex.select(key, "line_no", T.strip("_raw").alias("line"))
    return ex.filter(F.length("line") > 0)


def scan_text_lines(spark: SparkSession, path: str, keep_blank: bool = False, whole: bool = False) -> DataFrame:
    """S5 from text files: ``(file, line_no, line)`` with the 0-based line
    number in the whole file, lines stripped and blanks dropped (they count).

    A file is read in splits.  A line's place is its split's place in the file,
    then its place in the split; numbers come from a scan over those places
    alone (lines per segment, then a prefix sum), so no file is read by one task.
    ``whole``: number through all files of the folder in name order.
    ``keep_blank``: neither strip nor drop."""
    from tokenloom.operators.positions import ROW_ID, row_index, stage_rows

    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_at"))
    rows = stage_rows(raw, "text-lines")  # row ids rise within a split
    at = row_index(rows.select(ROW_ID, "file", "_at"), ["_at", ROW_ID], ["file"], out="line_no")
    if whole:  # a row a file
        sizes = at.groupBy("file").agg(F.count(F.lit(1)).alias("_n"))
        before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.select("file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
        at = at.join(starts, "file").withColumn("line_no", F.col("line_no") + F.col("_before"))
    d = rows.select(ROW_ID, "file", "value").join(at.select(ROW_ID, "line_no"), ROW_ID)
    if keep_blank:
        return d.select("file", "line_no", F.col("value").alias("line"))
    return d.select("file", "line_no", T.strip("value").alias("line")).filter(F.length("line") > 0)


def head_rows(df: DataFrame, n: int, order_cols) -> DataFrame:
    """The first ``n`` rows by position (``select(range(n))``):
    ``orderBy().limit()`` plans as a distributed top-k (TakeOrdered)."""
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    return df.orderBy(*order_cols).limit(n)
