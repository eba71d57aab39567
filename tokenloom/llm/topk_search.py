"""Exact top-k search by distributed histogram selection.

Queries come in blocks of bounded size.  For a block, every task scores all
its rows and counts scores per query in the bins of that query's interval; the
summed histograms say which bin holds the k-th best score, which becomes the
next interval, until it is one score wide.  A last pass keeps scores from
there up; ties at the k-th score go to the smaller id.

Vectors that are null, or hold null or non-finite components, take no part.
A row whose id equals the query's is not its candidate; rows that repeat are
candidates each.  Rows without an id are left out.  Vectors of another length
than the query's are compared over the query's length, missing places as 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BINS = 1024
HALF = 1 << 61


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """vec_id and v: floor(scale * x) of each component, as long."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x"))
    fine = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & fine)
    return v.select("vec_id", F.transform("x", lambda x: F.floor(F.lit(float(scale)) * x)).alias("v"))


def _matrix(vecs, dims: int) -> np.ndarray:
    if len(vecs) and all(len(v) == dims for v in vecs):
        return np.array(vecs, np.int64)
    out = np.zeros((len(vecs), dims), np.int64)
    for i, v in enumerate(vecs):
        out[i, : min(dims, len(v))] = v[:dims]
    return out


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer products; through doubles where those are exact."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if top < 2**53:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    return q @ c.T


def _histogram(shared, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, q, lo, width = shared.value
        counts: dict[tuple[int, int], int] = {}
        total = np.zeros((len(ids), BINS + 1), np.int64)
        for pdf in batches:
            for at in range(0, len(pdf), 1024):
                part = pdf.iloc[at : at + 1024]
                s = _scores(q, _matrix(part["v"].tolist(), q.shape[1]))
                b = np.minimum((s - lo[:, None]) // width[:, None], BINS)  # BINS: above the interval
                ok = (s >= lo[:, None]) & (ids[:, None] != part["vec_id"].to_numpy()[None, :])
                rows = np.broadcast_to(np.arange(len(ids))[:, None], b.shape)[ok]
                total += np.bincount(rows * (BINS + 1) + b[ok], minlength=total.size).reshape(total.shape)
        # The k-th best of all is at least the k-th best of this task: lower bins cannot matter.
        above = np.cumsum(total[:, ::-1], axis=1)[:, ::-1] - total
        r, b = np.nonzero((total > 0) & (above < k))
        yield pd.DataFrame({"q": r.astype(np.int32), "bin": b.astype(np.int32), "n": total[r, b]})

    return run


def _keep(shared, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, q, lo, _ = shared.value
        best = pd.DataFrame({"q": [], "vec_id": [], "score": []}, dtype="int64")
        for pdf in batches:
            for at in range(0, len(pdf), 1024):
                part = pdf.iloc[at : at + 1024]
                vec = part["vec_id"].to_numpy()
                s = _scores(q, _matrix(part["v"].tolist(), q.shape[1]))
                r, c = np.nonzero((s >= lo[:, None]) & (ids[:, None] != vec[None, :]))
                new = pd.DataFrame({"q": r, "vec_id": vec[c], "score": s[r, c]})
                best = pd.concat([best, new]).sort_values(["q", "score", "vec_id"], ascending=[True, False, True]).groupby("q").head(k)
        yield best

    return run


def topk_search(
    vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256, block: int = 1024
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best candidates in
    ``vectors`` of every row of ``queries`` (same columns).

    block: queries scored at once; only one block is on the driver.
    """
    spark = vectors.sparkSession
    cands = quantised(vectors, id_col, vec_col, scale)
    asked = quantised(queries, id_col, vec_col, scale)
    span = cands.agg(F.max(F.expr("aggregate(v, 0D, (a, x) -> greatest(a, abs(cast(x as double))))")).alias("m"), F.count(F.lit(1)).alias("n")).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not span["n"]:
        return spark.createDataFrame([], schema)
    result = None
    rows = asked.orderBy("vec_id").toLocalIterator(prefetchPartitions=False)
    while chunk := [r for _, r in zip(range(block), rows)]:
        ids = np.array([r["vec_id"] for r in chunk], np.int64)
        q = _matrix([r["v"] for r in chunk], max(1, max(len(r["v"]) for r in chunk)))
        bound = np.minimum(np.abs(q.astype(np.float64)).sum(axis=1) * (span["m"] or 0.0) + 1, float(HALF)).astype(np.int64)
        lo, width = -bound, -(-(2 * bound + 1) // BINS)
        while True:
            shared = spark.sparkContext.broadcast((ids, q, lo, width))
            hist = cands.mapInPandas(_histogram(shared, k), "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
            over = Window.partitionBy("q").orderBy(F.desc("bin"))
            # The bin where the count from above reaches k; if never, every candidate is wanted.
            place = hist.withColumn("upto", F.sum("n").over(over)).where((F.col("upto") >= k) & (F.col("upto") - F.col("n") < k))
            found = {r["q"]: r["bin"] for r in place.select("q", "bin").collect()}  # one row a query of the block
            step = np.array([found.get(i, 0) for i in range(len(ids))], np.int64)
            lo = lo + step * width
            if (width == 1).all():
                break
            width = np.where(width > 1, -(-width // BINS), width)
        shared = spark.sparkContext.broadcast((ids, q, lo, width))
        kept = cands.mapInPandas(_keep(shared, k), "q int, vec_id long, score long")
        best = kept.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, int(x)) for i, x in enumerate(ids)], "q int, query_id long")
        part = best.join(F.broadcast(names), "q").select("query_id", "rank", "vec_id", "score")
        result = part if result is None else result.unionByName(part)
    return result if result is not None else spark.createDataFrame([], schema)


ORACLE_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
