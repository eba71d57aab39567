"""Documents of one template that never link: the exact rest step stays linear."""

import random

from pyspark.sql import functions as F

from tokenloom.llm import near_dedup


def _sets(spark, n, seed=3):
    rnd = random.Random(seed)
    template = ["t%d" % i for i in range(200)]
    memo, rows = near_dedup.WordHash(), []
    for node in range(n):
        ws = list(template)
        for at in rnd.sample(range(200), 14):
            ws[at] = f"n{node}_{at}"
        rows.append((node, near_dedup.shingle_set(" ".join(ws), 5, memo).view("int64").tolist()))
    return spark.createDataFrame(rows, "node long, shingles array<long>")


def test_template_documents_give_no_pairs(spark):
    for n in (50, 200):
        sets = _sets(spark, n)
        labels = sets.select("node", F.col("node").alias("label"))
        assert near_dedup.rare_pairs(sets, labels, 80).count() <= n


def test_every_similar_pair_is_found(spark):
    rnd = random.Random(5)
    rows = []
    for node in range(120):
        base = random.Random(node % 9).sample(range(1000), 30)
        s = sorted({x if rnd.random() > 0.06 else 2000 + rnd.randrange(50) for x in base})
        rows.append((node, s))
    sets = spark.createDataFrame(rows, "node long, shingles array<long>")
    labels = sets.select("node", F.col("node").alias("label"))
    pairs = near_dedup.rare_pairs(sets, labels, 80)
    got = {(r["a"], r["b"]) for r in near_dedup.linked(pairs, sets, 80).collect()}
    full = [set(s) for _, s in rows]
    want = {(a, b) for a in range(120) for b in range(a + 1, 120) if 100 * len(full[a] & full[b]) >= 80 * len(full[a] | full[b])}
    assert want and got == want
