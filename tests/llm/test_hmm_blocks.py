"""Words meet the corpus once a block, not once a document."""

from pyspark.sql import functions as F

from tokenloom.llm import hmm_lm


def test_a_block_has_a_row_for_each_distinct_word(spark):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.expr("encode('Alpha beta beta ' || (id % 5), 'utf-8')").alias("text"), (F.col("id") % 4 == 0).alias("held_out")
    )
    rows = docs.coalesce(1).mapInArrow(hmm_lm._blocks, hmm_lm.BLOCKS).collect()
    words = [r for r in rows if r.word is not None]
    assert len(rows) - len(words) == 400 and len({r.block for r in rows}) == 1
    assert {bytes(r.word): r.c for r in words} == {b"alpha": 300, b"beta": 600, b"\n": 300, **{str(i).encode(): 60 for i in range(5)}}
    assert len(words) == 8  # of 2,000 words in 400 documents


def test_scores_do_not_depend_on_blocks(spark):
    text = F.concat_ws(" ", F.lit("the"), *[F.concat(F.lit("w"), (F.col("id") * p % 37).cast("string")) for p in (3, 5, 7, 11)])
    docs = spark.range(300).select(F.when(F.col("id") % 50 != 0, F.col("id")).alias("doc_id"), text.alias("text"))
    docs = docs.unionByName(docs.where("doc_id % 3 = 0"))  # rows that repeat, ids that are null

    def scores(d):
        return sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in hmm_lm.hmm_scores(d, states=3, rounds=2).collect())

    one, many = scores(docs.coalesce(1)), scores(docs.repartition(13))
    assert one == many and len(one) == docs.count()
