"""Property tests: pack/unpack identity, block-size law, split
sides disjoint and complete, results independent of partitioning."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tokenloom.operators import augment, pack, splits
from tokenloom.operators.positions import prefix_sum

B = 5


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 13), min_size=1, max_size=12), st.sampled_from([0, 1, 2]))
def test_pack_unpack_identity(spark, lens, lookahead):
    rows, t = [], 0
    for i, n in enumerate(lens):
        rows.append((i * 7, list(range(t, t + n))))
        t += n
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>").repartition(3)
    blocks = pack.pack_blocks(df, "ids", ["doc_id"], [], B, lookahead=lookahead, materialize=False)
    kept = t - t % B
    sizes = [len(r["tokens"][:B]) for r in blocks.collect()]
    assert sum(sizes) == kept and all(s == B for s in sizes)
    flat = [r["token"] for r in pack.unpack(blocks, B).orderBy("pos").collect()]
    assert flat == list(range(kept))


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 500), st.floats(0.0, 0.9))
def test_split_sides_disjoint_complete(spark, n, r):
    lengths = spark.createDataFrame([(n,)], "n long")
    b = {x["split"]: (x["start"], x["end"]) for x in splits.split_ratio(lengths, r).collect()}
    assert b["train"][0] == 0 and b["train"][1] == b["val"][0] and b["val"][1] == n
    assert b["val"][1] - b["val"][0] == int(n * r)


def test_independent_of_partitioning(spark):
    docs = [(i, ". ".join(f"w{i} s{j}" for j in range(i % 5 + 1))) for i in range(120)]
    base = spark.createDataFrame(docs, "doc_id long, text string")
    results = []
    for parts, shuffle in ((1, "3"), (7, "11")):
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        df = base.repartition(parts)
        a = sorted(map(tuple, augment.augment_text(df, p=0.3, seed=9).select("doc_id", "text").collect()))
        sizes = df.withColumn("n", F.length("text"))
        o = sorted(map(tuple, prefix_sum(sizes, "n", ["doc_id"], n_buckets=int(shuffle)).select("doc_id", "offset").collect()))
        g = sorted(map(tuple, augment.shuffle_global(augment.split_sentences(df), seed=9).select("doc_id", "pos", "order").collect()))
        results.append((a, o, g))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]
