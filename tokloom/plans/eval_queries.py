"""Catalogue queries for evaluation, candidate scoring and run logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokloom.config import VAL_RATIO
from tokloom.functions.text import step_number
from tokloom.operators import evals as E
from tokloom.operators import runlog as R
from tokloom.operators import scoring as SC
from tokloom.operators import stream as S
from tokloom.plans.stream_queries import doc_stream, split_stream
from tokloom.session import scratch
from tokloom.sources.tables import load

HASH_VOCAB = 30100
ALPHA = 1.0
LOSS_BATCH = 64
MAX_BATCHES = [20, 50, 0]  # 0: the whole validation split
TOKENS_PER_MICRO = 2048


def samples(spark, sf):
    """Pass/fail samples: each labelled document is one sample of the task
    named by its source; it passed when its quality label is 1."""
    lab = load(spark, sf, "labels").select("doc_id", "quality")
    docs = load(spark, sf, "documents").select("doc_id", "source")
    return lab.join(docs, "doc_id").select(
        F.col("source").alias("task_id"), F.col("doc_id").alias("sample_id"),
        (F.col("quality") == 1).alias("passed"))


def q_correct_per_task(spark, sf):
    return E.correct_per_task(samples(spark, sf))


def q_pass_at_k(spark, sf):
    m = E.mean_pass_at_k(E.correct_per_task(samples(spark, sf)))
    return m.select("k", F.round("pass_at_k", 6).alias("pass_at_k"), "n_tasks")


def q_task_progress(spark, sf):
    """Each task's position among all tasks, the total, and its pass@1."""
    pr = E.progress(E.correct_per_task(samples(spark, sf)))
    return pr.select("task_id", "position", "total", F.round("pass_at_1", 6).alias("pass_at_1"))


def q_sample_grid(spark, sf):
    """Every benchmark problem expanded to its 20 sample slots."""
    from tokloom.config import N_SAMPLES
    probs = load(spark, sf, "benchmark").select(F.col("item_id").alias("task_id"))
    return E.expand_samples(probs, N_SAMPLES).select("task_id", "sample_id")


def q_validity_rate(spark, sf):
    """A7 over the quality verdicts of the labelled documents, per source."""
    return E.validity_rate(samples(spark, sf), "passed", ["task_id"]).withColumn(
        "pass_rate", F.round("pass_rate", 6))


def q_completions(spark, sf):
    t = load(spark, sf, "conversations")
    u = t.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    a = t.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("raw"))
    cut, full = E.completion_text(F.col("prompt"), F.col("raw"))
    return u.join(a, ["conv_id", "turn"]).select(
        "conv_id", "turn", cut.alias("completion"), F.length(full).alias("full_len"))


def _bigrams(spark, sf):
    """(stream, tokens before the validation split, counts over those)."""
    st = doc_stream(spark, sf)
    n_train, _, _ = S.split_sizes(S.total_tokens(st), VAL_RATIO)
    pairs = SC.next_pairs(st).where(F.col("pos") < n_train)
    return st, n_train, SC.ngram_counts(pairs)


def q_ngram_counts(spark, sf):
    return _bigrams(spark, sf)[2]


def q_trigram_counts(spark, sf):
    """T13 at order 3 over the training split."""
    part, n = split_stream(spark, sf, "train")
    return SC.ngram_counts(SC.next_ngrams(S.blocks(part, 256, ahead=2), 3, HASH_VOCAB), SC.count_parts(spark, n))


def q_fivegram_counts(spark, sf):
    """T13 at order 5."""
    part, n = split_stream(spark, sf, "train")
    return SC.ngram_counts(SC.next_ngrams(S.blocks(part, 256, ahead=4), 5, HASH_VOCAB), SC.count_parts(spark, n))


def _ngram_levels(spark, sf, order):
    """Counts of orders ``order`` down to 2, each from the one above.  A level is
    written: it is read for the result and for the level below."""
    part, total = split_stream(spark, sf, "train")
    blk = S.blocks(part, 256, ahead=order - 1)
    parts = SC.count_parts(spark, total)
    counts, levels = SC.ngram_counts(SC.next_ngrams(blk, order, HASH_VOCAB), parts), []
    for n in range(order, 1, -1):
        path = scratch(spark, f"ngrams-{n}")
        counts.write.parquet(path)
        levels.append(spark.read.schema(counts.schema).parquet(path))
        if n > 2:
            counts = SC.lower_order(levels[-1], blk, n, HASH_VOCAB, parts)
    return levels


def q_ngram_levels(spark, sf):
    """The context tree of orders 4 to 2, each level summed from the one
    above."""
    out = None
    for n, counts in zip((4, 3, 2), _ngram_levels(spark, sf, 4)):
        level = counts.select(F.lit(n).alias("order_n"), "ctx", "nxt", "n")
        out = level if out is None else out.unionByName(level)
    return out


def q_ngram_sample(spark, sf):
    """T13's candidates through T11 and T12: one next token per context."""
    counts = _bigrams(spark, sf)[2]
    return SC.sample_next(SC.prune(SC.ngram_candidates(counts), 50, 0.9), 7)


def _val_losses(spark, sf):
    st, n_train, counts = _bigrams(spark, sf)
    # documents before the split have no such pair
    tail = st.where(F.col("start_off") + F.size("ids") > n_train)
    val = SC.next_pairs(tail).where(F.col("pos") > n_train)
    tl = SC.ngram_token_losses(counts, val, ALPHA, HASH_VOCAB)
    return tl.withColumn("batch_id", F.floor((F.col("pos") - n_train - 1) / LOSS_BATCH))


def _val_loss(spark, sf, weight):
    tl = _val_losses(spark, sf)
    return E.mean_loss_multi(tl, MAX_BATCHES, weight).select(
        "max_batches", F.round("loss", 6).alias("loss"), "n")


def q_val_loss_batch(spark, sf):
    return _val_loss(spark, sf, "batch")


def q_val_loss_token(spark, sf):
    return _val_loss(spark, sf, "token")


def q_perplexity(spark, sf):
    ev = load(spark, sf, "events")
    scaled = ev.groupBy("event_type").agg((F.avg("value") / 100).alias("loss")) \
        .withColumn("measure", F.lit("mean_scaled"))
    raw = ev.groupBy("event_type").agg(F.max("value").alias("loss")) \
        .withColumn("measure", F.lit("max_raw"))
    both = E.with_perplexity(scaled.unionByName(raw))
    return both.select("event_type", "measure", F.round("loss", 6).alias("loss"),
                       F.round("perplexity", 6).alias("perplexity"))


def candidates(spark, sf):
    """Candidate scores: context = supplier, token = part, logit = summed
    (quantity - 25) / 10 (aggregated first: the pair is not unique)."""
    li = load(spark, sf, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("ctx"), F.col("l_partkey").alias("token")) \
        .agg((F.sum(F.col("l_quantity") - 25) / 10).alias("logit"))


def q_softmax(spark, sf):
    p = SC.softmax(candidates(spark, sf))
    return p.select("ctx", "token", F.round("prob", 6).alias("prob"))


def q_topk_ties(spark, sf):
    return SC.top_k(candidates(spark, sf), 3).select("ctx", "token", "logit")


def _pruned(spark, sf):
    return SC.prune(candidates(spark, sf), 50, 0.9)


def q_nucleus(spark, sf):
    return _pruned(spark, sf).select("ctx", "token", F.round("prob", 6).alias("prob"))


def q_penalised(spark, sf):
    c = candidates(spark, sf)
    hist = load(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select(
        F.col("l_suppkey").alias("ctx"), F.col("l_partkey").alias("token"))
    seen = SC.with_seen(c, hist)
    return seen.select("ctx", "token", *[
        F.round(SC.penalised_logit("logit", 1.3, 0.7, m), 6).alias(f"logit_{m}")
        for m in ("divide", "signed")])


def q_sample_next(spark, sf):
    return SC.sample_next(_pruned(spark, sf), 7)


def run_log(spark, sf):
    """Events as a training run log: one run per event type, raw step =
    event id, loss = value / 100, fixed tokens per micro-batch."""
    ev = load(spark, sf, "events")
    return ev.select(F.col("event_type").alias("run_id"), F.col("event_id").alias("raw_step"),
                     "ts", (F.col("value") / 100).alias("loss"),
                     F.lit(TOKENS_PER_MICRO).cast("long").alias("tokens"))


def q_step_rollup(spark, sf):
    r = R.step_rollup(run_log(spark, sf), accum=16, log_every=10)
    return r.select("run_id", "step", F.round("loss", 6).alias("loss"), "n_micro", "tokens")


def q_throughput(spark, sf):
    t = R.throughput(run_log(spark, sf))
    return t.select("run_id", "raw_step", "tokens_so_far",
                    F.round("elapsed_s", 6).alias("elapsed_s"),
                    F.round("tok_per_s", 6).alias("tok_per_s"))


def q_retention(spark, sf):
    log = run_log(spark, sf)
    man = log.select("run_id", F.format_string("step_%07d", F.col("raw_step")).alias("name"))
    man = man.withColumn("step", step_number("name"))
    return R.newest_n(man, 3).select("run_id", "name", "step")


QUERIES = {
    "correct_per_task": q_correct_per_task,
    "pass_at_k": q_pass_at_k,
    "task_progress": q_task_progress,
    "sample_grid": q_sample_grid,
    "validity_rate": q_validity_rate,
    "completions": q_completions,
    "ngram_counts": q_ngram_counts,
    "trigram_counts": q_trigram_counts,
    "fivegram_counts": q_fivegram_counts,
    "ngram_levels": q_ngram_levels,
    "ngram_sample": q_ngram_sample,
    "val_loss_batch": q_val_loss_batch,
    "val_loss_token": q_val_loss_token,
    "perplexity": q_perplexity,
    "softmax": q_softmax,
    "topk_ties": q_topk_ties,
    "nucleus": q_nucleus,
    "penalised": q_penalised,
    "sample_next": q_sample_next,
    "step_rollup": q_step_rollup,
    "throughput": q_throughput,
    "retention": q_retention,
}
