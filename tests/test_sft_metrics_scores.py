"""SFT rows and masked losses, run-metric analytics, score tables, structs."""

import math

from pyspark.sql import functions as F

from tokenloom.functions import structs
from tokenloom.operators import metrics, pack, scores, sft, tokenizer

B = 8


def _vocab(spark, texts):
    return tokenizer.build_vocab(spark.createDataFrame([(t,) for t in texts], "text string"), "text", vocab_size=50)


def test_sft_rows_edge_cases(spark):
    """sft_rows: empty and absent context, prompt longer than B, response
    ending exactly at B."""
    conv = [
        (1, 0, "system", "be brief"), (1, 1, "user", "hi there"), (1, 2, "assistant", "hello"),
        (2, 0, "user", "w " * 10), (2, 1, "assistant", "ok"),
        (3, 0, "user", "q"), (3, 1, "assistant", "a b c d e f"),
    ]
    df = spark.createDataFrame(conv, "conv_id long, turn long, role string, text string")
    tri = {r["conv_id"]: r for r in sft.triples_from_conversations(df).collect()}
    assert tri[1]["context"] == "be brief" and tri[2]["context"] == "" and tri[3]["context"] == ""
    v = _vocab(spark, [t for *_, t in conv])
    ids = {r["token"]: r["id"] for r in v.collect()}
    rows = {r["conv_id"]: r for r in sft.sft_rows(sft.triples_from_conversations(df), v, block=B).collect()}
    for r in rows.values():
        assert len(r["input_ids"]) == B and len(r["labels"]) == B
    # conv 1: prompt "hi there be brief" -> 4 ids masked, response "hello" + end id
    assert list(rows[1]["labels"][:6]) == [-100] * 4 + [ids["hello"], 0]
    assert list(rows[1]["input_ids"][6:]) == [0, 0] and list(rows[1]["labels"][6:]) == [-100, -100]
    # conv 2: prompt of 10 tokens > B: no valid label
    assert set(rows[2]["labels"]) == {-100}
    # conv 3: 1 prompt id + 6 response ids + end id = exactly B
    assert list(rows[3]["labels"]) == [-100] + [ids[w] for w in "a b c d e f".split()] + [0]
    shifted = {r["conv_id"]: r["n_valid"] for r in pack.shift_labels(sft.sft_rows(sft.triples_from_conversations(df), v, block=B)).collect()}
    assert shifted == {1: 2, 2: 0, 3: 7}

    model = spark.createDataFrame([(ids["hi"], ids["there"], 3, 3)], "prev int, next int, c long, c_prev long")
    pairs = sft.position_pairs(spark.createDataFrame([rows[2]]).select("conv_id", "turn", "input_ids", "labels"))
    losses = sft.masked_losses(pairs, model, 50)
    assert sft.masked_mean_loss(losses, (), guard=True).first()["masked_loss"] == 0.0
    assert sft.masked_mean_loss(losses, (), guard=False).first()["masked_loss"] is None


def _reference_loop(losses, patience_limit):
    best, pat, out = math.inf, 0, []
    for step, loss in losses:
        before, p_before = best, pat
        improved = loss < best
        if improved:
            best, pat = loss, 0
        else:
            pat += 1
        out.append((step, before, improved, p_before, pat, pat >= patience_limit))
    return out


def test_running_best_patience_early_stop(spark):
    """losses fixture: ties, plateau, NaN, immediate improvement."""
    seq = [2.0, 1.5, 1.5, float("nan"), 1.6, 1.4, 1.4, 1.4, 1.4, 1.0, 3.0]
    rows = [(7, i * 50, i, v) for i, v in enumerate(seq)]
    df = spark.createDataFrame(rows, "run_id long, step long, eval_idx long, loss double")
    e = metrics.patience(metrics.running_best(df, "run_id", "step", "loss"), "run_id", "step", "eval_idx")
    got = {r["step"]: r for r in e.collect()}
    for step, before, improved, pb, pa, _ in _reference_loop([(s, v) for _, s, _, v in rows], 3):
        r = got[step]
        assert r["best_before"] == before and r["improved"] == improved
        assert (r["patience_before"], r["patience_after"]) == (pb, pa)
    stop = metrics.early_stop(e, 3).first()["stop_step"]
    ref = [r for r in _reference_loop([(s, v) for _, s, _, v in rows], 3) if r[5]]
    assert stop == ref[0][0] == 200
    assert metrics.best_value(df).first()["best_step"] == 9 * 50


def test_checkpoint_rules_and_latest(spark):
    """2.16 item 18 (nested periodic rule) and O3 numeric vs lexicographic."""
    steps = spark.range(0, 301).select(F.lit(1).alias("run_id"), F.col("id").alias("step"))
    ev = spark.createDataFrame([(1, s, s == 0) for s in range(0, 301, 50)], "run_id long, step long, improved boolean")
    nested = [r["step"] for r in metrics.checkpoint_events(steps, ev, every=100, nested=True).orderBy("step").collect()]
    flat = [r["step"] for r in metrics.checkpoint_events(steps, ev, every=30, nested=False).orderBy("step").collect()]
    assert nested == [0, 100, 200, 300]
    assert flat == [0] + list(range(30, 301, 30))
    names = spark.createDataFrame([(1, "checkpoint-9", 9), (1, "checkpoint-10", 10), (1, "ckpt_step_0000050.pkl", 50)], "run_id long, name string, step long")
    d = names.filter(F.col("name").startswith("checkpoint-"))
    assert metrics.latest_checkpoint(d, rule="numeric").first()["latest"] == "checkpoint-10"
    assert metrics.latest_checkpoint(d, rule="lexicographic").first()["latest"] == "checkpoint-9"
    kept = [r["step"] for r in metrics.retain_last(names, 2).orderBy("step").collect()]
    assert kept == [10, 50]


def test_lr_schedule_formula(spark):
    df = spark.range(0, 100).withColumnRenamed("id", "step")
    got = {r["step"]: r["lr"] for r in metrics.lr_schedule(df, "step", 1e-3, 10, 100, 0.5).collect()}
    for s in (0, 5, 10, 50, 99):
        ref = 1e-3 * s / 10 if s < 10 else 1e-3 * (0.5 * 0.5 * (1 + math.cos(math.pi * min(s - 10, 90) / 90)) + 0.5)
        assert abs(got[s] - ref) < 1e-15


def test_nucleus_peaked_flat_tied(spark):
    """scores fixture: peaked (best probability > p), flat, tied."""
    rows = [(0, 0, 10.0), (0, 1, 0.0), (0, 2, 0.0)] + [(1, t, 1.0) for t in range(5)] + [(2, 0, 2.0), (2, 1, 2.0), (2, 2, 0.0)]
    df = spark.createDataFrame(rows, "seq_id long, token long, logit double")
    kept = scores.nucleus(df, k=4, p=0.9, temperature=1.0)
    by = {}
    for r in kept.collect():
        by.setdefault(r["seq_id"], []).append((r["rank"], r["token"], r["q"]))
    assert [t for _, t, _ in sorted(by[0])] == [0]  # fallback: best alone (its cumulative > p)
    assert [t for _, t, _ in sorted(by[1])] == [0, 1, 2]  # flat: top-4 of 5, 0.25 each, cumulative <= 0.9 keeps 3
    assert [t for _, t, _ in sorted(by[2])] == [0]  # tie (0.468 each): id 0 ranks first; the second crosses p
    for seq, ks in by.items():
        assert abs(sum(q for *_, q in ks) - 1.0) < 1e-8
    a = {r["seq_id"]: r["token"] for r in scores.sample_token(kept, 11).collect()}
    b = {r["seq_id"]: r["token"] for r in scores.sample_token(kept.repartition(5), 11).collect()}
    assert a == b and a[0] == 0


def test_log_softmax_and_standardize(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0, 3.0])], "vec_id long, embedding array<float>")
    lp = {r["token"]: r["logprob"] for r in scores.log_softmax(scores.vectors_to_scores(df)).collect()}
    z = math.log(sum(math.exp(x) for x in (1, 2, 3)))
    assert all(abs(lp[i] - (v - z)) < 1e-12 for i, v in enumerate((1.0, 2.0, 3.0)))
    n = scores.standardize_vectors(df, "embedding", 1e-5).first()["normed"]
    var = 2 / 3
    assert abs(n[0] - (-1 / math.sqrt(var + 1e-5))) < 1e-9


def test_flatten_struct_and_merge_config(spark):
    """nested fixture: struct<a:struct<b:int,c:int>,d:int>."""
    df = spark.createDataFrame([(1, ((2, 3), 4))], "id int, cfg struct<a:struct<b:int,c:int>,d:int>")
    got = sorted((r["key"], r["value"]) for r in structs.flatten_struct(df, "cfg", ["id"]).collect())
    assert got == [("a.b", "2"), ("a.c", "3"), ("d", "4")]
    m = spark.createDataFrame([({"lr": "1", "bs": "8"}, {"lr": "2", "run": "x"})], "l map<string,string>, r map<string,string>")
    assert m.select(structs.render_map(structs.merge_config("l", "r")).alias("c")).first()["c"] == "bs=8;lr=2;run=x"
