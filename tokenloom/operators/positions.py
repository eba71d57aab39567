"""Global positions without a single-task window.

An un-partitioned ``Window.orderBy`` moves every row to one task.  Instead:

1. one small aggregate (a driver action returning ``n_buckets`` doubles) gives
   approximate quantiles of the leading order key;
2. ``Bucketizer`` (JVM binary search) maps each row to a bucket: buckets are
   contiguous ranges of the order key, balanced by quantiles, so a dense or a
   sparse key, or one stream holding most rows, still spreads over all tasks;
3. a running sum inside ``(streams, bucket)`` (one shuffle, sorted);
4. bucket totals (at most streams x buckets rows) are prefix-summed in one
   small window and joined back (AQE broadcasts them after measuring).

Pass ``key_source`` (a cheap frame holding the order key, e.g. the key
column of the source table) or precomputed ``splits`` so the sketch job does
not recompute an expensive upstream plan.

``prefix_sum`` and ``row_index`` scan order keys and sizes alone where rows
carry texts or arrays: the rows are stored once with a row id, and the number
comes back by a join on that id (the scan has a few bytes a row, so Spark
broadcasts it while it is small).  No text or array is sorted or shuffled to
learn a position.

The result is exact; only bucket *sizes* depend on the sketch.  Order keys
must be unique within a stream (add a tie-breaker column otherwise).  A null
stream is a stream of its own, and null order keys come first, as in Spark's
own ascending order: no row is lost.  Text keys keep their byte order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from tokenloom.session import cut_lineage

#: Rows that one bucket should hold, and the most buckets that one sketch gives.
BUCKET_ROWS, MOST_BUCKETS = 1_000_000, 4_096


def default_buckets(spark) -> int:
    try:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # noqa: BLE001
        n = 200
    return max(4, 2 * n)


def _numeric_key(df: DataFrame, key: str):
    """The leading order key as a double that never falls where the key rises
    (timestamps as epoch microseconds, text by its first six bytes).  Equal
    doubles only share a bucket; inside it the key itself decides."""
    t = df.schema[key].dataType.typeName()
    if t.startswith("timestamp"):
        return F.unix_micros(F.col(key).cast("timestamp")).cast("double")
    if t == "date":
        return F.unix_date(F.col(key)).cast("double")
    if t in ("string", "varchar", "char", "binary"):
        first = F.hex(F.substring(F.col(key).cast("binary"), 1, 6))
        return F.conv(F.rpad(first, 12, "0"), 16, 10).cast("double")
    return F.col(key).cast("double")


def quantile_splits(df: DataFrame, key: str, n_buckets: int) -> list[float]:
    """Bucket boundaries: approximate quantiles of ``key`` (one small job).

    Pass a *cheap* frame here (e.g. the key column of the source table, which
    parquet reads alone): boundaries only balance buckets, any monotone set
    of boundaries gives exact results.  At least ``n_buckets``; more where
    buckets would exceed ``BUCKET_ROWS`` rows."""
    k = _numeric_key(df, key)
    # One text literal: a list would become thousands of expressions.
    points = F.split(F.lit(" ".join(str(i / MOST_BUCKETS) for i in range(1, MOST_BUCKETS))), " ").cast("array<double>")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(k, points, 10_000).alias("q")).first()
    q = [float(x) for x in (row["q"] or [])]
    want = min(MOST_BUCKETS, max(n_buckets, -(-row["n"] // BUCKET_ROWS)))
    return sorted({q[i * MOST_BUCKETS // want - 1] for i in range(1, want)} if q else set())


def _bucketize(df: DataFrame, key: str, n_buckets: int, splits=None, key_source: DataFrame | None = None):
    if splits is None:
        splits = quantile_splits(key_source if key_source is not None else df.select(key), key, n_buckets)
    if not splits:  # empty or constant key: one bucket
        return df.withColumn("_bkt", F.lit(0))
    edges = [float("-inf")] + sorted(set(splits)) + [float("inf")]
    tmp = df.withColumn("_okey", _numeric_key(df, key))
    out = Bucketizer(splits=edges, inputCol="_okey", outputCol="_bktd", handleInvalid="keep").transform(tmp)
    # A null key has no bucket number: one before all others (nulls first).
    return out.withColumn("_bkt", F.coalesce(F.col("_bktd").cast("int"), F.lit(-1))).drop("_okey", "_bktd")


def _agg(op: str, c):
    return {"sum": F.sum, "min": F.min, "max": F.max}[op](c)


def _combine(op: str, a, b):
    if op == "sum":
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    return (F.least if op == "min" else F.greatest)(a, b)  # both skip nulls


def running(
    df: DataFrame,
    value,
    op: str,
    order_cols,
    streams=(),
    out: str = "run",
    inclusive: bool = True,
    n_buckets: int | None = None,
    splits=None,
    key_source: DataFrame | None = None,
    total_out: str | None = None,
) -> DataFrame:
    """Running ``sum``/``min``/``max`` of ``value`` in ``order_cols`` order per
    stream, computed in buckets (no single-task or single-stream window).

    The input is read twice (in-bucket window and bucket totals, which prune
    to different columns, so Spark cannot share one exchange): pass a scan or
    a materialised table when the upstream plan is expensive.

    ``inclusive=False`` excludes the current row (null for the first row of
    a stream under min/max, 0 under sum).  ``value`` is a column name or a
    Column; nulls are ignored as Spark aggregates ignore them.
    ``total_out``: also add the aggregate of the row's whole stream.
    """
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    streams = [streams] if isinstance(streams, str) else list(streams)
    nb = n_buckets or default_buckets(df.sparkSession)
    v = F.col(value) if isinstance(value, str) else value
    if op == "sum":
        v = F.coalesce(v, F.lit(0))
    b = _bucketize(df.withColumn("_v", v), order_cols[0], nb, splits, key_source)
    # One explicit exchange on (streams, bucket): the window and the bucket
    # totals both consume that partitioning without a further shuffle.
    # The struct makes null streams equal to each other in every step.
    b = b.withColumn("_sk", F.struct(*streams) if streams else F.lit(0)).repartition("_sk", "_bkt")
    frame_end = Window.currentRow if inclusive else -1
    w_in = Window.partitionBy("_sk", "_bkt").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, frame_end)
    within = b.withColumn("_run", _agg(op, F.col("_v")).over(w_in))
    totals = b.groupBy("_sk", "_bkt").agg(_agg(op, F.col("_v")).alias("_btot"))
    w_all = Window.partitionBy("_sk")
    w_b = w_all.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    # streams x buckets rows; the join side is the output of a shuffle, so
    # AQE measures it and broadcasts it only when it is small.
    whole = [_agg(op, F.col("_btot")).over(w_all).alias(total_out)] if total_out else []
    starts = totals.select("_sk", "_bkt", _agg(op, F.col("_btot")).over(w_b).alias("_bpre"), *whole)
    res = within.join(starts, on=["_sk", "_bkt"], how="inner")
    return res.withColumn(out, _combine(op, F.col("_bpre"), F.col("_run"))).drop("_sk", "_bkt", "_run", "_bpre", "_v")


#: Column with the row id of staged rows.
ROW_ID = "_rid"


def stage_rows(df: DataFrame, name: str = "rows") -> DataFrame:
    """``df`` as a stage table with a stored row id, so that columns computed
    from some of its columns can be joined back (rows staged already stay)."""
    if ROW_ID in df.columns:
        return df
    return cut_lineage(df.withColumn(ROW_ID, F.monotonically_increasing_id()), name)


def hash_splits(spark, bits: int = 32, n_buckets: int | None = None) -> list[float]:
    """Bucket boundaries of a keyed hash, which is uniform on [0, 2^bits): no sketch is needed."""
    n = n_buckets or default_buckets(spark)
    return [i * 2.0**bits / n for i in range(1, n)]


def _scan_keys(df: DataFrame, needed: list[str], scan: Callable[[DataFrame], DataFrame], outs: list[str]) -> DataFrame:
    """``scan(df)``, run on the ``needed`` columns alone where others are wide."""
    wide = (Ty.StringType, Ty.BinaryType, Ty.ArrayType, Ty.MapType, Ty.StructType)
    rest = [f for f in df.schema.fields if f.name not in needed and f.name != ROW_ID]
    if not any(isinstance(f.dataType, wide) for f in rest):
        return scan(df)
    rows = stage_rows(df)
    found = scan(rows.select(ROW_ID, *needed)).select(ROW_ID, *outs)
    out = rows.drop(*outs).join(found, ROW_ID)
    return out if ROW_ID in df.columns else out.drop(ROW_ID)


def prefix_sum(
    df: DataFrame,
    size_col: str,
    order_cols,
    streams=(),
    out: str = "offset",
    n_buckets: int | None = None,
    splits=None,
    key_source: DataFrame | None = None,
    total_out: str | None = None,
) -> DataFrame:
    """Exclusive running sum of ``size_col`` in ``order_cols`` order, per stream:
    the start position of each row in the concatenated stream (0 first)."""
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    streams = [streams] if isinstance(streams, str) else list(streams)
    size = F.coalesce(F.col(size_col).cast("long"), F.lit(0))

    def scan(d: DataFrame) -> DataFrame:
        return running(d, size, "sum", order_cols, streams, out=out, inclusive=False, n_buckets=n_buckets,
                       splits=splits, key_source=key_source, total_out=total_out)

    needed = list(dict.fromkeys([*streams, *order_cols, size_col]))
    return _scan_keys(df, needed, scan, [out, *([total_out] if total_out else [])])


def row_index(df: DataFrame, order_cols, streams=(), out: str = "row_no", n_buckets: int | None = None,
              splits=None, key_source: DataFrame | None = None) -> DataFrame:
    """0-based global row number in ``order_cols`` order (per stream)."""
    tmp = df.withColumn("_one", F.lit(1))
    return prefix_sum(tmp, "_one", order_cols, streams, out=out, n_buckets=n_buckets, splits=splits,
                      key_source=key_source).drop("_one")


def stream_totals(df: DataFrame, size_col: str, streams=(), out: str = "total") -> DataFrame:
    """Total size per stream: a small frame (one row per stream)."""
    streams = [streams] if isinstance(streams, str) else list(streams)
    size = F.coalesce(F.col(size_col).cast("long"), F.lit(0))
    if streams:
        return df.groupBy(*streams).agg(F.sum(size).alias(out))
    return df.agg(F.coalesce(F.sum(size), F.lit(0)).alias(out))


def attach_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Add the columns of ``scalars`` (a global aggregate: one row, or one row
    a stream) to every row.  Spark plans this as a broadcast nested loop over
    those few rows, so ``scalars`` must not grow with the data."""
    return df.withColumn("_k1", F.lit(1)).join(F.broadcast(scalars.withColumn("_k1", F.lit(1))), "_k1").drop("_k1")
