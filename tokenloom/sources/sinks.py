"""Sinks and stage guards.

Outputs are parquet tables (text where a plain corpus file is wanted);
order is a column (``chunk_id``, ``block_id``), never file order.  Writes go
through Spark's commit protocol, so a lost executor only retries its tasks
and a stage is either fully visible (``_SUCCESS``) or not.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from fnmatch import fnmatchcase
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.session import cut_lineage


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def drop_output(spark: SparkSession, path: str) -> None:
    """Remove a stored output that no plan reads any more."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def output_exists(spark: SparkSession, path: str, min_bytes: int = 1) -> bool:
    """A committed output (``_SUCCESS`` present) of at least ``min_bytes``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    if fs.getFileStatus(p).isDirectory():
        ok = fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS"))
        return bool(ok) and fs.getContentSummary(p).getLength() >= min_bytes
    return fs.getFileStatus(p).getLen() >= min_bytes


def write_corpus(chunks: DataFrame, path: str, order: str = "chunk_id", col: str = "text", fmt: str = "parquet") -> None:
    """The corpus, one record per chunk.  Parquet keeps ``order`` as a
    column; ``fmt="text"`` writes plain lines range-partitioned and sorted by
    ``order`` (file names follow the range order)."""
    if fmt == "text":
        chunks.repartitionByRange(order).sortWithinPartitions(order).select(col).write.mode("overwrite").text(path)
    else:
        chunks.select(order, col).sortWithinPartitions(order).write.mode("overwrite").parquet(path)


def write_blocks(blocks: DataFrame, path: str, partition_cols=("lang",), order: str = "block_id") -> None:
    """The token block table (the reference's memmap re-aimed as a
    table), partitioned by stream/split, ``block_id`` sorted inside files."""
    cols = list(partition_cols)
    # By range of the block number too: a language is no single task.
    blocks.repartitionByRange(*cols, order).sortWithinPartitions(*cols, order).write.mode("overwrite").partitionBy(*cols).parquet(path)


def write_if_absent(df: DataFrame, path: str, min_bytes: int = 1) -> DataFrame:
    """Skip the stage when a committed, non-empty output exists (checked
    before planning the job); otherwise write it.  Returns the stored table."""
    spark = df.sparkSession
    if not output_exists(spark, path, min_bytes):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def mirror_output(spark: SparkSession, path: str, path2: str) -> DataFrame:
    """A second copy of a stored output when the target is missing."""
    if not output_exists(spark, path2):
        spark.read.parquet(path).write.mode("overwrite").parquet(path2)
    return spark.read.parquet(path2)


def require_nonempty(df: DataFrame, what: str = "output", col: str | None = None) -> DataFrame:
    """Fail when nothing came out (no rows, or a zero total of ``col``).
    One small job (a ``limit 1`` probe or one aggregate)."""
    if col is None:
        if df.isEmpty():
            raise ValueError(f"{what} holds no rows")
    else:
        total = df.agg(F.coalesce(F.sum(col), F.lit(0)).alias("t")).first()["t"]
        if not total:
            raise ValueError(f"{what}: {col} adds up to nothing")
    return df


def append_metrics(metrics: DataFrame, path: str, attempt: int, run: str = "run_id") -> None:
    """Append step metrics of a run (a resumed run keeps its run id);
    ``attempt`` tags the writer so re-written steps can be resolved.  Rows go
    to the writers by range of run and step and lie in that order in the files,
    so a reader of one run skips the others by the files' statistics; a folder
    a run would make as many files as there are runs."""
    tagged = metrics.withColumn("attempt", F.lit(attempt)).repartitionByRange(run, "step").sortWithinPartitions(run, "step")
    tagged.write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str, keys=("run_id", "step", "name")) -> DataFrame:
    """S13 read side: one row per ``keys``, the last attempt wins
    (``max_by`` over the attempt; a plain aggregate, no window)."""
    d = spark.read.parquet(path)
    keys = list(keys)
    vals = [c for c in d.columns if c not in (*keys, "attempt")]
    return d.groupBy(*keys).agg(*[F.max_by(c, "attempt").alias(c) for c in vals])


def _local_path(spark: SparkSession, path: str) -> str | None:
    """The path as the local file system names it; None in any other store."""
    fs, p = _fs(spark, path)
    return str(p.toUri().getPath()) if fs.getScheme() == "file" else None


def _folder(key: str, value: str | None) -> str:
    """The folder that Spark's writers make for a partition value."""
    value = re.sub("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]", lambda m: f"%{ord(m[0]):02X}", value or "")
    return f"{key}={value or '__HIVE_DEFAULT_PARTITION__'}"


def _write_small_files(batches: Iterator[pd.DataFrame], root: str, run: str, name: str) -> int:
    """A text file for each (run, name) of sorted rows (run, name, line), seen
    under its own name when it is whole; returns the number of files."""
    n, at, file, whole = 0, None, None, ""
    part = f".part-{uuid.uuid4().hex}"  # hidden from readers, and no other attempt's
    for b in batches:
        for r, c, line in b.itertuples(index=False, name=None):
            if (r, c) != at:
                if file:
                    file.close()
                    os.replace(file.name, whole)
                at, n = (r, c), n + 1
                folder = f"{root}/{_folder(run, r)}/{_folder(name, c)}"
                os.makedirs(folder, exist_ok=True)
                file, whole = open(f"{folder}/{part}", "w", encoding="utf-8", newline=""), f"{folder}/part-00000.txt"  # noqa: SIM115
            file.write(f"{'' if line is None else line}\n")
    if file:
        file.close()
        os.replace(file.name, whole)
    return n


def write_checkpoint_files(files: DataFrame, path: str, run: str = "run_id", name: str = "name", per_task: int = 2000) -> None:
    """A small file for each checkpoint, in a folder of its run and name (the
    catalog that :func:`list_checkpoints` reads).  The cost is in the files, not
    in the rows, so the number of tasks follows from the number of files, and
    each task moves its own files into place (the default commit moves all of
    them one by one on the driver).  In the local file system the tasks make the
    files themselves: Hadoop starts a ``chmod`` for each folder, file and checksum."""
    spark = files.sparkSession
    files = cut_lineage(files, "checkpoint-names")
    tasks = max(files.count() // per_task, spark.sparkContext.defaultParallelism)
    root = _local_path(spark, path)
    if root is None:
        w = files.repartition(tasks, run).write.mode("overwrite").partitionBy(run, name)
        w.option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
        return
    (line,) = [c for c in files.columns if c not in (run, name)]
    rows = files.select(F.nullif(F.col(run).cast("string"), F.lit("")).alias("r"), F.nullif(F.col(name).cast("string"), F.lit("")).alias("c"),
                        F.col(line).alias("line"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"n": [_write_small_files((b.astype(object).where(b.notna(), None) for b in batches), root, run, name)]})

    fs, p = _fs(spark, path)
    fs.delete(p, True)
    fs.mkdirs(p)
    rows.repartition(tasks, "r", "c").sortWithinPartitions("r", "c").mapInPandas(write, "n long").agg(F.sum("n")).collect()
    fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")).close()


def _hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")


def _local_entries(folder: str, glob: str | None) -> Iterator[tuple[str, bool]]:
    """What a folder holds, as ``binaryFile`` lists it, without empty files:
    (path, whether it is a folder)."""
    with os.scandir(folder) as entries:
        for e in entries:
            if e.is_dir():
                if not _hidden(e.name) or e.name.startswith(("_metadata", "_common_metadata")):
                    yield e.path, True
            elif not _hidden(e.name) and (glob is None or fnmatchcase(e.name, glob)) and e.stat().st_size:
                yield e.path, False


def _local_files(spark: SparkSession, root: str, glob: str | None) -> DataFrame:
    """Paths of the files under a local folder.  Its folders, and those in them,
    are dealt to the tasks, which list them: neither statuses nor names of the
    files pass through the driver."""

    def walk(batches: Iterator[pd.DataFrame], levels: int) -> Iterator[pd.DataFrame]:
        found: list[tuple[str, bool]] = []
        for b in batches:
            todo = [(p, inner, 0) for p, inner in b.itertuples(index=False, name=None)]
            while todo:
                p, inner, level = todo.pop()
                if not inner or level == levels:
                    found.append((p, inner))
                    if len(found) >= 10_000:
                        yield pd.DataFrame(found, columns=["path", "inner"])
                        found = []
                else:
                    todo.extend((*e, level + 1) for e in _local_entries(p, glob))
        yield pd.DataFrame(found, columns=["path", "inner"])

    schema = "path string, inner boolean"
    d = spark.createDataFrame([(root, True)], schema)
    for levels in (1, 1, -1):
        d = d.repartition(spark.sparkContext.defaultParallelism * 4, "path").mapInPandas(partial(walk, levels=levels), schema)
    return d.select(F.concat(F.lit("file:"), "path").alias("path"))


def list_checkpoints(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Checkpoints under ``path`` with the step parsed from the name
    (``ckpt_step_0000050.pkl`` or ``checkpoint-50``, as a file or a folder
    anywhere in the path).  File contents are never read: tasks list a folder of
    the local file system, elsewhere (or with a pattern of more than ``*`` and
    ``?``) ``binaryFile`` lists with only ``path`` selected.  One row per
    checkpoint."""
    root = _local_path(spark, path)
    if root and os.path.isdir(root) and not re.search(r"[*?{}\[\]\\]", root) and not re.search(r"[{}\[\]\\]", glob or ""):
        files = _local_files(spark, root.rstrip("/") or "/", glob)
    else:
        r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        if glob:
            r = r.option("pathGlobFilter", glob)
        files = r.load(path).select("path")
    name = F.regexp_extract("path", "(ckpt_step_[0-9]+\\.pkl|checkpoint-[0-9]+)", 1)
    run = F.regexp_extract("path", "run_id=([0-9]+)", 1)
    step = F.regexp_extract(name, "([0-9]+)", 1)
    d = files.select(F.nullif(run, F.lit("")).try_cast("long").alias("run_id"), F.nullif(name, F.lit("")).alias("name"),
                     F.nullif(step, F.lit("")).try_cast("long").alias("step"))
    return d.filter(F.col("name").isNotNull()).distinct()
