import math

from pyspark.sql import functions as F

from tokloom.functions.stats import pass_at_k, perplexity
from tokloom.operators import evals as E
from tokloom.operators import scoring as SC


def test_pass_at_k_values(spark):
    cases = [(20, 3, 5, 0.600877), (5, 0, 1, 0.0), (5, 5, 5, 1.0), (5, 3, 3, 1.0)]
    df = spark.createDataFrame([c[:3] for c in cases], "n int, c int, k int")
    got = [r.p for r in df.select(pass_at_k("n", "c", "k").alias("p")).collect()]
    for (n, c, k, exp), g in zip(cases, got):
        assert abs(g - exp) < 1e-6 and abs(g - (1 - math.comb(n - c, k) / math.comb(n, k))) < 1e-12


def test_pass_at_k_skips_large_k(spark):
    per = spark.createDataFrame([("t1", 3, 1), ("t2", 20, 3)],
                                "task_id string, n_samples long, n_correct long")
    got = {r.k: (r.pass_at_k, r.n_tasks) for r in E.mean_pass_at_k(per).collect()}
    assert got[5][1] == 1 and got[10][1] == 1 and got[1][1] == 2


def test_mean_loss_weights_and_perplexity(spark):
    rows = [(0, 1.0)] * 4 + [(1, 3.0)] * 4 + [(2, 10.0)]
    df = spark.createDataFrame(rows, "batch_id long, loss double")
    b = E.mean_loss(df, None, "batch").first().loss
    t = E.mean_loss(df, None, "token").first().loss
    assert abs(b - (1 + 3 + 10) / 3) < 1e-12 and abs(t - (4 + 12 + 10) / 9) < 1e-12
    assert abs(E.mean_loss(df, 2, "batch").first().loss - 2.0) < 1e-12
    assert E.mean_loss(df.where("false"), None, "batch").first().loss is None
    p = spark.createDataFrame([(2.0,), (300.0,), (None,)], "l double") \
        .select(perplexity("l").alias("p")).collect()
    assert abs(p[0].p - math.exp(2)) < 1e-9 and p[1].p == math.inf and p[2].p is None


def scores(spark, rows):
    return spark.createDataFrame(rows, "ctx int, token int, logit double")


def test_top_k_keeps_ties(spark):
    df = scores(spark, [(0, 1, 5.0), (0, 2, 4.0), (0, 3, 4.0), (0, 4, 1.0), (1, 9, 2.0),
                        (2, 1, 1.0), (2, 2, 1.0), (2, 3, 1.0)])
    got = sorted((r.ctx, r.token) for r in SC.top_k(df, 2).collect())
    assert got == [(0, 1), (0, 2), (0, 3), (1, 9), (2, 1), (2, 2), (2, 3)]
    assert SC.top_k(df, 0).count() == df.count()


def brute_nucleus(logits, top_p):
    order = sorted(logits, key=lambda t: (-t[1], t[0]))
    m = max(l for _, l in order)
    e = [math.exp(l - m) for _, l in order]
    s = sum(e)
    kept, before = [], 0.0
    for (tok, _), x in zip(order, e):
        if before <= top_p:
            kept.append(tok)
        before += x / s
    return sorted(kept)


def test_nucleus_and_sampling(spark):
    import random
    rnd = random.Random(5)
    rows = [(c, t, rnd.uniform(-3, 3)) for c in range(4) for t in range(30)]
    df = scores(spark, rows)
    got = SC.nucleus(df, 0.7).collect()
    for c in range(4):
        exp = brute_nucleus([(t, l) for cc, t, l in rows if cc == c], 0.7)
        assert sorted(r.token for r in got if r.ctx == c) == exp
    pr = SC.prune(df, 10, 0.9)
    sums = pr.groupBy("ctx").agg(F.sum("prob").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in sums)
    a = {r.ctx: r.token for r in SC.sample_next(pr, 7).collect()}
    b = {r.ctx: r.token for r in SC.sample_next(pr.repartition(3), 7).collect()}
    assert a == b and len(a) == 4


def test_penalty_modes(spark):
    df = scores(spark, [(0, 1, 2.0), (0, 2, -2.0), (0, 3, 1.0)])
    hist = spark.createDataFrame([(0, 1), (0, 2), (0, 2)], "ctx int, token int")
    d = {r.token: r.logit for r in SC.penalise(df, hist, 2.0, 0.5, "divide").collect()}
    s = {r.token: r.logit for r in SC.penalise(df, hist, 2.0, 0.5, "signed").collect()}
    assert d == {1: 2.0, 2: -2.0, 3: 2.0}
    assert s == {1: 2.0, 2: -8.0, 3: 2.0}


def test_mean_loss_multi_matches_single(spark):
    rows = [(b, float(b % 7) + i / 10) for b in range(30) for i in range(1 + b % 3)]
    df = spark.createDataFrame(rows, "batch_id long, loss double")
    for w in ("batch", "token"):
        multi = {r.max_batches: (r.loss, r.n) for r in E.mean_loss_multi(df, [5, 20, 0], w).collect()}
        for mb in (5, 20, 0):
            one = E.mean_loss(df, mb, w).first()
            assert abs(multi[mb][0] - one.loss) < 1e-12 and multi[mb][1] == one.n


def test_step_rollup_counts_micro_batches_from_one(spark):
    from tokloom.operators import runlog as R
    # run a: 40 micro-batches with gaps in their ids, steps 1 and 2 whole, 8 left over
    rows = [("a", 3 * i + 7, float(i), 10) for i in range(40)] + [("b", i, float(i), 10) for i in range(15)]
    log = spark.createDataFrame(rows, "run_id string, raw_step long, loss double, tokens long")
    got = sorted(tuple(r) for r in R.step_rollup(log, accum=16, log_every=1).select(
        "run_id", "step", "loss", "n_micro", "tokens").collect())
    assert got == [("a", 1, 15.0, 16, 160), ("a", 2, 31.0, 16, 160)]
    assert [r.step for r in R.step_rollup(log, 16, 2).collect()] == [2]


def test_validity_rate_counts_null_as_not_valid(spark):
    df = spark.createDataFrame([("x", True), ("x", None), ("x", False), ("y", True)], "g string, ok boolean")
    got = {r.g: (r.n_total, r.n_valid, r.pass_rate) for r in E.validity_rate(df, "ok", ["g"]).collect()}
    assert got == {"x": (3, 1, 1 / 3), "y": (1, 1, 1.0)}


def test_nucleus_running_mass(spark):
    rows = [("c", t, math.log(p)) for t, p in enumerate([0.5, 0.3, 0.15, 0.05])]
    df = spark.createDataFrame(rows, "ctx string, token int, logit double")
    assert {r.token for r in SC.nucleus(df, 0.79).collect()} == {0, 1}
    assert {r.token for r in SC.nucleus(df, 0.9).collect()} == {0, 1, 2}
    plan = SC.prune(df, 3, 0.9)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_ngrams_of_any_order(spark):
    from collections import Counter

    from tokloom.operators import stream as S
    docs = spark.createDataFrame([(0, [1, 2, 3]), (1, [1, 2]), (2, [3, 1, 2, 3, 4, 5, 1])], "doc_id long, ids array<int>")
    flat = [1, 2, 3, 1, 2, 3, 1, 2, 3, 4, 5, 1]
    blk = S.blocks(S.stream_offsets(docs, ["doc_id"]), 4)
    for vocab, most in ((6, 5), (1 << 20, 4), (1 << 31, 3)):
        bits, above = SC.id_bits(vocab), None
        for n in (5, 4, 3, 2):
            def key(ids):
                longs = [ids[i:i + 63 // bits] for i in range(0, len(ids), 63 // bits)]
                longs = [sum(x << bits * (len(c) - 1 - k) for k, x in enumerate(c)) for c in longs]
                return longs[0] if len(longs) == 1 else tuple(longs)
            want = Counter((key(flat[i:i + n - 1]), flat[i + n - 1]) for i in range(len(flat) - n + 1))
            counts = SC.ngram_counts(SC.next_ngrams(blk, n, vocab))
            got = {(r.ctx if n <= most else tuple(r.ctx), r.nxt): r.n for r in counts.collect()}
            assert got == want
            if above is not None:  # summed from the level above
                low = {(r.ctx, r.nxt): r.n for r in SC.lower_order(above, blk, n + 1, vocab).collect()}
                assert low == want
            above = counts if n <= most and n > 2 else None


def test_sums_are_finished_by_tasks_of_bounded_rows(spark):
    rows = [(i % 7, i % 3) for i in range(400)]
    pairs = spark.createDataFrame(rows, "ctx long, nxt int")
    counts = SC.ngram_counts(pairs, 23)
    assert counts.rdd.getNumPartitions() == 23
    assert {(r.ctx, r.nxt): r.n for r in counts.collect()} == {(c, x): rows.count((c, x)) for c, x in set(rows)}
    assert SC.count_parts(spark, 500 * SC.ROWS_A_TASK) == 500
