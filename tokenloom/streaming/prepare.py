"""Structured Streaming corpus preparation (S4, ST1-ST4).

The record step of corpus preparation is stateless, so the *same* Column
expressions as the batch path run on a ``readStream`` DataFrame (array
form: no explode, no aggregation).  Resume is Spark's: a checkpoint
location plus ``trigger(availableNow=True)`` processes only files not yet
committed, and the file sink is exactly-once through its metadata log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from tokenloom.functions import text as T
from tokenloom.operators import augment


def stream_corpus(spark: SparkSession, directory: str, schema: Ty.StructType, glob: str | None = None,
                  max_files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Record-at-a-time read of a corpus folder (a streaming source needs
    a directory; a file is selected with ``pathGlobFilter``)."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(directory)


def stream_prepare(stream: DataFrame, key: str = "doc_id", col: str = "text", min_chars: int = 100,
                   count_delim: str = T.EN_COUNT_DELIM, min_marks: int = 2, delim: str = T.EN_SENTENCE_DELIM,
                   p: float = 0.05, seed=42) -> DataFrame:
    """ST1: strip, filter and augment each record; identical to the batch
    :func:`tokenloom.operators.augment.prepare_documents`."""
    return augment.prepare_documents(stream, key, col, min_chars, count_delim, min_marks, delim, p, seed)


def run_available(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partition_cols=(),
                  state_partitions: int | None = None, progress: str | None = None):
    """ST3: process everything available now into a file sink and stop;
    re-running with the same checkpoint resumes where it stopped.  Returns
    the finished query (its ``recentProgress`` holds the last ST4 counters).

    ``progress``: table to which the ST4 counters of every batch are appended
    while the query runs (see :func:`record_progress`).

    ``state_partitions``: number of state-store partitions of a stateful
    query.  Spark fixes it from ``spark.sql.shuffle.partitions`` when the
    query first starts (and keeps it in the checkpoint), so it is set only
    around ``start()`` and restored afterwards."""
    spark = stream.sparkSession
    w = stream.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        q = w.trigger(availableNow=True).start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    if progress:
        record_progress(q, spark, progress)
    q.awaitTermination()
    return q


def stream_chunks(stream: DataFrame, path: str, checkpoint: str, order: str = "doc_id", col: str = "text",
                  passed: str | None = None, chunk_size: int = 1000):
    """ST2: number the records of a stream as they arrive and give each its
    chunk: ``chunk_size`` source records each, whatever the files and batches.

    Every batch writes ``(chunk_id, position, text)`` rows (text null where
    ``passed`` is false: the record counts, its text does not) under
    ``path/rows/batch=<id>``, by as many tasks as it has; then the ledger
    ``path/ledger/batch=<id>`` says how many records lie before it and in it.
    Both are overwritten by a replayed batch, which starts from the ledger of
    earlier batches, so its rows come out the same.  Records of a batch are
    numbered in ``order``, which must be unique."""
    from tokenloom.operators.positions import row_index, stage_rows

    def flush(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ok = F.col(passed) if passed else F.lit(True)
        rows = stage_rows(batch.select(F.col(order), F.when(ok, F.col(col)).alias("text")), "stream-batch")
        before, n = records_before(spark, path, batch_id), rows.count()
        number = F.lit(before) + F.col("_rn")
        out = row_index(rows, [order], out="_rn").select(
            F.floor(number / F.lit(chunk_size)).cast("long").alias("chunk_id"), (number % F.lit(chunk_size)).cast("int").alias("position"), "text"
        )
        out.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        ledger = spark.createDataFrame([(before, n)], "before long, n long").coalesce(1)
        ledger.write.mode("overwrite").parquet(f"{path}/ledger/batch={batch_id}")

    q = stream.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def records_before(spark: SparkSession, path: str, batch_id: int) -> int:
    """Records that the ledger has of batches before this one."""
    from tokenloom.sources.sinks import path_exists

    if not path_exists(spark, f"{path}/ledger"):
        return 0
    ledger = spark.read.schema("before long, n long, batch long").parquet(f"{path}/ledger").filter(F.col("batch") < F.lit(batch_id))
    return ledger.agg(F.max(F.col("before") + F.col("n")).alias("n")).first()["n"] or 0


def stream_chunk_texts(rows: DataFrame, chunk_size: int = 1000, sep: str = " ") -> DataFrame:
    """The chunks of :func:`stream_chunks` as texts, ``(chunk_id, text,
    n_records, is_full)``, by the rule of ``augment.assemble_chunks``: a full
    chunk ends with ``sep``, a partial one without any text is absent.
    Groups hold at most ``chunk_size`` records."""
    texts = F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("position", "text"))))
    d = rows.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n_records"), F.transform(texts, lambda x: x["text"]).alias("_l"))
    d = d.withColumn("is_full", F.col("n_records") == F.lit(chunk_size)).filter(F.col("is_full") | (F.size("_l") > 0))
    body = F.array_join("_l", sep)
    return d.select("chunk_id", F.when(F.col("is_full"), F.concat(body, F.lit(sep))).otherwise(body).alias("text"), "n_records", "is_full")


PROGRESS_SCHEMA = "batch_id long, num_input_rows long, input_rows_per_sec double, processed_rows_per_sec double"


def _progress_row(p) -> tuple:
    return int(p["batchId"]), int(p["numInputRows"]), float(p.get("inputRowsPerSecond") or 0.0), float(p.get("processedRowsPerSecond") or 0.0)


def record_progress(query, spark: SparkSession, path: str, every: float = 0.1, flush: int = 1000) -> None:
    """ST4: append the counters of every batch of a running query to a table.

    Spark keeps only the last updates, so they are read while the query runs
    and at most ``flush`` rows wait on the driver.  Should a stall let updates
    go unread, this fails rather than leave a gap."""
    spark.createDataFrame([], PROGRESS_SCHEMA).write.mode("append").parquet(path)
    rows, last, gap, done = [], None, None, False
    while not done:
        done = not query.isActive  # read once more after the end
        updates = list(query.recentProgress)
        ids = [(p["batchId"], p["timestamp"]) for p in updates]
        at = ids.index(last) + 1 if last in ids else 0
        if last and not at and updates and updates[0]["batchId"] > last[0] + 1:
            gap = gap or (last[0], updates[0]["batchId"])
        rows += [_progress_row(p) for p in updates[at:]]
        last = ids[-1] if ids else last
        if rows and (done or len(rows) >= flush):
            spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(path)
            rows = []
        if not done:
            query.awaitTermination(every)
    if gap:
        raise RuntimeError(f"progress of the batches between {gap[0]} and {gap[1]} was not read in time")


def progress_rows(spark: SparkSession, query) -> DataFrame:
    """ST4: the last progress counters that Spark keeps of a query, as a
    DataFrame ``(batch_id, num_input_rows, input_rows_per_sec,
    processed_rows_per_sec)``; :func:`record_progress` has those of all batches."""
    return spark.createDataFrame([_progress_row(p) for p in query.recentProgress], PROGRESS_SCHEMA)
