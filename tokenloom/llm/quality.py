"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

    score = sigmoid(w0 + <w, x> + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2])

It is fitted by Adam on a bounded sample of labelled rows (the least hashes of
doc_id) in one task; scoring reads every whole text.

Null text is empty and is scored like any other text.  Repeated labels of an
id are averaged; labels that are null are no labels.  With no labelled rows
every score is 0.5.
"""

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import WordHash, id_crc

HASHED = 1 << 14
N_STATS = 16
FACTORS = 8
HASHES_KEPT = 1 << 16  # of words, by a task; as many tasks as cores hold texts beside them
FEATURES = "idx array<int>, val array<float>, stats array<float>"


def statistics(text: str, n_chars, raw: bytes, ws: list[bytes], repeat_max: int, distinct: int) -> list[float]:
    """Shares and averages that tell prose from junk; n_chars is metadata."""
    c = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, nw = max(1, len(raw)), max(1, len(ws))
    upper, lower, digit = int(c[65:91].sum()), int(c[97:123].sum()), int(c[48:58].sum())
    high, space, lines = int(c[128:].sum()), int(c[32] + c[9] + c[13]), raw.split(b"\n")
    prose = int(c[[44, 46, 39, 45]].sum())
    symbols = len(raw) - upper - lower - digit - high - space - int(c[10]) - prose
    meta = float(n_chars) if n_chars is not None and not pd.isna(n_chars) else float(len(text))
    return [
        upper / n, digit / n, high / n, space / n, symbols / n, prose / n, int(c[33]) / n, int(c[10]) / n,
        np.log1p(len(raw)) / 10, len(raw) / nw / 10, distinct / nw, repeat_max / nw, len(set(lines)) / len(lines),
        np.log1p(len(raw) / len(lines)) / 10, np.log1p(max(0.0, meta)) / 10, float(not ws),
    ]


def features(text: str, n_chars, memo: WordHash) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Hashed word ids, their unit-length log counts, and the statistics."""
    raw = text.encode("utf-8", "replace")
    ws = raw.lower().split()
    h = memo.of(ws)
    full, counts = np.unique(h, return_counts=True)
    idx, back = np.unique((full >> np.uint64(20)).astype(np.int64) % HASHED, return_inverse=True)
    val = np.log1p(np.bincount(back, weights=counts, minlength=len(idx)))
    val /= np.sqrt((val**2).sum()) if len(val) else 1.0
    return idx.astype(np.int32), val.astype(np.float32), statistics(text, n_chars, raw, ws, int(counts.max(initial=0)), len(full))


class FactorisationMachine:
    def __init__(self, dims: int, factors: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        # Column 0: linear weight; the rest: factors.
        self.p = np.concatenate((np.zeros((dims, 1)), rng.normal(0, 0.05, (dims, factors))), axis=1).astype(np.float32)
        self.w0, self.mean, self.scale = 0.0, np.zeros(N_STATS), np.ones(N_STATS)

    def rows(self, idx, val, stats):
        """Flat ids and values of a batch, and where each row starts."""
        z = np.clip((np.asarray(stats, np.float64).reshape(-1, N_STATS) - self.mean) / self.scale, -6, 6) / 4
        own = np.arange(HASHED, HASHED + N_STATS, dtype=np.int64)
        i = np.concatenate([np.concatenate((a, own)) for a in idx]).astype(np.int64)
        v = np.concatenate([np.concatenate((a, b)) for a, b in zip(val, z)]).astype(np.float32)
        starts = np.concatenate(([0], np.cumsum([len(a) + N_STATS for a in idx])[:-1]))
        return i, v, starts.astype(np.int64)

    def forward(self, i, v, starts):
        pv = self.p[i] * v[:, None]
        sums = np.add.reduceat(pv, starts, axis=0)
        squares = np.add.reduceat(pv[:, 1:] ** 2, starts, axis=0).sum(axis=1)
        return self.w0 + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(axis=1) - squares), sums, pv

    def score(self, idx, val, stats) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(*self.rows(idx, val, stats))[0], -30, 30).astype(np.float64)))

    def fit(self, idx, val, stats, y, steps: int = 1500, batch: int = 64, rate: float = 0.02, decay: float = 1e-4, seed: int = 1):
        stats = np.asarray(stats, np.float64).reshape(-1, N_STATS)
        self.mean, self.scale = stats.mean(axis=0), stats.std(axis=0) + 1e-6
        share = np.clip(y.mean(), 0.01, 0.99)
        self.w0 = float(np.log(share / (1 - share)))
        m, s, t, rng = np.zeros_like(self.p), np.zeros_like(self.p), 0, np.random.default_rng(seed)
        epochs = max(4, -(-steps * batch // len(y)))
        for epoch in range(epochs):
            for pick in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
                i, v, starts = self.rows([idx[j] for j in pick], [val[j] for j in pick], stats[pick])
                out, sums, pv = self.forward(i, v, starts)
                err = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y[pick]).astype(np.float32)
                row = np.repeat(np.arange(len(pick)), np.diff(np.append(starts, len(i))))
                g = np.empty_like(pv)
                g[:, 0] = err[row] * v
                g[:, 1:] = err[row, None] * v[:, None] * (sums[row, 1:] - pv[:, 1:])
                used, back = np.unique(i, return_inverse=True)
                order = np.argsort(back, kind="stable")
                total = np.add.reduceat(g[order], np.searchsorted(back[order], np.arange(len(used))), axis=0) / len(pick)
                total += decay * self.p[used]
                t += 1
                m[used] = 0.9 * m[used] + 0.1 * total
                s[used] = 0.99 * s[used] + 0.01 * total**2
                step = rate / (1 + 4 * epoch / epochs)
                self.p[used] -= step * (m[used] / (1 - 0.9 ** min(t, 200))) / (np.sqrt(s[used] / (1 - 0.99 ** min(t, 1000))) + 1e-6)
                self.w0 -= step * float(err.mean())
        return self


def _feature_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memo = WordHash(HASHES_KEPT)
    for pdf in batches:
        for at in range(0, len(pdf), 500):
            part = pdf.iloc[at : at + 500]
            out = [(y, *features(t, n, memo)) for y, t, n in zip(part["y"], part["text"], part["n_chars"])]
            yield pd.DataFrame(out, columns=["y", "idx", "val", "stats"])


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    fm = FactorisationMachine(HASHED + N_STATS, FACTORS)
    fm.fit(pdf["idx"].tolist(), pdf["val"].tolist(), np.stack(pdf["stats"].tolist()), pdf["y"].to_numpy(np.float64))
    return pd.DataFrame({"model": [pickle.dumps(fm)]})


def inputs(docs: DataFrame) -> DataFrame:
    chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), chars.alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame, sample: int = 12_000, holdout: int = 5) -> FactorisationMachine | None:
    """Model learned from at most ``sample`` labelled rows outside the held-out fold."""
    y = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    y = y.where(id_crc() % holdout != 0).orderBy(F.xxhash64("doc_id")).limit(sample)
    rows = inputs(docs).join(F.broadcast(y), "doc_id").dropDuplicates(["doc_id"])  # at most ``sample`` ids
    rows = rows.select("y", "text", "n_chars").mapInPandas(_feature_rows, "y double, " + FEATURES)
    model = rows.groupBy(F.lit(1).alias("one")).applyInPandas(_fit, "model binary").collect()
    return pickle.loads(model[0]["model"]) if model else None


def score(docs: DataFrame, model: FactorisationMachine | None, threshold: float = 0.3, holdout: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted, and the columns of ``docs`` as the struct ``row``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        memo, fm = WordHash(HASHES_KEPT), shared.value
        for text, chars in texts:
            out = np.full(len(text), 0.5)
            for at in range(0, len(text) if fm else 0, 256):
                f = [features(t, n, memo) for t, n in zip(text.iloc[at : at + 256], chars.iloc[at : at + 256])]
                out[at : at + len(f)] = fm.score(*zip(*f))
            yield pd.Series(out)

    chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    udf = F.pandas_udf(run, "double")
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       udf(F.coalesce("text", F.lit("")), chars).alias("score"))
    return kept.select("doc_id", (id_crc() % holdout == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "row")

