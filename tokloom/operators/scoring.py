"""Candidate scoring and pruning.

Candidates are rows (ctx, token, logit), one for each token at most, so a
context has no more rows than the vocabulary has tokens: that bound is what
lets maxima, sums, ranks and running mass be windows over one partitioning
by context (one exchange for the whole chain).  Running mass in a fixed
order inside one task also makes the nucleus edge independent of the
partitioning.  Top-k uses ``rank``, so Catalyst cuts groups before the
shuffle as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokloom.config import TEMPERATURE_FLOOR
from tokloom.functions.hashing import phash


def softmax(df: DataFrame, ctx: str = "ctx", logit: str = "logit",
            out: str = "prob") -> DataFrame:
    """exp(l - max) / sum(exp(l - max)) per context."""
    w = Window.partitionBy(ctx)
    e = df.withColumn("_e", F.exp(F.col(logit) - F.max(logit).over(w)))
    return e.withColumn(out, F.col("_e") / F.sum("_e").over(w)).drop("_e")


def penalise(scores: DataFrame, history: DataFrame, penalty: float,
             temperature: float, mode: str = "divide", ctx: str = "ctx",
             token: str = "token", logit: str = "logit") -> DataFrame:
    """T10 + J5: tokens already seen in the context get the repetition
    penalty, then every logit is divided by max(temperature, 1e-8).

    mode="divide" divides whatever the sign (so negative logits rise);
    mode="signed" divides positive logits and multiplies negative ones."""
    j = with_seen(scores, history, ctx, token)
    return j.withColumn(logit, penalised_logit(logit, penalty, temperature, mode)).drop("_seen")


def with_seen(scores: DataFrame, history: DataFrame, ctx: str = "ctx",
              token: str = "token") -> DataFrame:
    """Scores with ``_seen``, null unless the context's history holds the
    token."""
    seen = history.select(ctx, token).distinct().withColumn("_seen", F.lit(True))
    return scores.join(seen, [ctx, token], "left")


def penalised_logit(logit: str, penalty: float, temperature: float, mode: str) -> Column:
    """T10 on a row of ``with_seen``."""
    l = F.col(logit)
    if mode == "signed":
        pen = F.when(l > 0, l / penalty).otherwise(l * penalty)
    else:
        pen = l / penalty
    l2 = F.when(F.col("_seen").isNotNull() & F.lit(penalty != 1.0), pen).otherwise(l)
    return l2 / F.lit(max(temperature, TEMPERATURE_FLOOR))


def top_k(df: DataFrame, k: int, ctx: str = "ctx", logit: str = "logit") -> DataFrame:
    """O3: keep rows not below the k-th largest logit (ties kept); k = 0
    disables; k larger than the group keeps all."""
    if not k or k <= 0:
        return df
    w = Window.partitionBy(ctx).orderBy(F.desc(logit))
    return df.withColumn("_rk", F.rank().over(w)).where(F.col("_rk") <= k).drop("_rk")


def nucleus(df: DataFrame, top_p: float, ctx: str = "ctx", token: str = "token",
            logit: str = "logit") -> DataFrame:
    """In descending logit order, drop a row when the probability mass
    *before* it exceeds top_p (the first row always stays); 1.0 disables."""
    if top_p >= 1.0:
        return df
    before = (Window.partitionBy(ctx).orderBy(F.desc(logit), token)
              .rowsBetween(Window.unboundedPreceding, -1))
    p = softmax(df, ctx, logit, "_p")
    cum = p.withColumn("_before", F.coalesce(F.sum("_p").over(before), F.lit(0.0)))
    return cum.where(F.col("_before") <= top_p).drop("_p", "_before")


def prune(df: DataFrame, top_k_: int, top_p: float, ctx: str = "ctx",
          token: str = "token", logit: str = "logit") -> DataFrame:
    """Top-k, then nucleus, then renormalised probabilities."""
    return softmax(nucleus(top_k(df, top_k_, ctx, logit), top_p, ctx, token, logit),
                   ctx, logit, "prob")


def sample_next(probs: DataFrame, seed: int, ctx: str = "ctx", token: str = "token",
                prob: str = "prob") -> DataFrame:
    """One draw per context with probability ``prob`` (Gumbel-max
    with the portable hash as the uniform source)."""
    u = (phash(seed, F.col(ctx), F.col(token)) + F.lit(0.5)) / F.lit(4294967296.0)
    g = F.log(F.col(prob)) - F.log(-F.log(u))
    return probs.withColumn("_g", g).groupBy(ctx).agg(
        F.max_by(token, "_g").alias("token"))


def next_pairs(stream: DataFrame) -> DataFrame:
    """W4 as rows: (pos, ctx, nxt) for every token position p >= 1 of the
    ordered stream, where ctx is the id at p-1.  Pairs inside a document
    come from the array; the pair across a boundary meets the next
    document through an equi-join on offset."""
    inner = stream.select(
        F.posexplode(F.arrays_zip(
            F.slice("ids", 1, F.size("ids") - 1).alias("ctx"),
            F.slice("ids", 2, F.size("ids")).alias("nxt"))).alias("i", "z"), "start_off")
    inner = inner.select((F.col("start_off") + F.col("i") + 1).alias("pos"),
                         F.col("z.ctx").alias("ctx"), F.col("z.nxt").alias("nxt"))
    last = stream.select((F.col("start_off") + F.size("ids")).alias("pos"),
                         F.element_at("ids", -1).alias("ctx"))
    first = stream.select(F.col("start_off").alias("pos"), F.col("ids")[0].alias("nxt"))
    cross = last.join(first, "pos")
    return inner.unionByName(cross)


def id_bits(vocab_size: int) -> int:
    """Bits of an id in a packed context."""
    return max(1, (vocab_size - 1).bit_length())


def context_key(ids: list[Column], vocab_size: int) -> Column:
    """A context as a number: its ids, oldest first, side by side in one long;
    contexts that need more bits are an array of such longs."""
    bits = id_bits(vocab_size)
    per = 63 // bits
    longs = []
    for low in range(0, len(ids), per):
        key = F.lit(0).cast("long")
        for x in ids[low:low + per]:
            key = F.shiftleft(key, bits).bitwiseOR(x.cast("long"))
        longs.append(key)
    return longs[0] if len(longs) == 1 else F.array(*longs)


def next_ngrams(blk: DataFrame, n: int, vocab_size: int) -> DataFrame:
    """W4 for order ``n`` over stream blocks (blk, at, ids, ahead), n - 1 ids
    ahead at least: (pos, ctx, nxt) for every position p >= n - 1, ctx the
    n - 1 ids before it as a ``context_key``.  A context belongs to the block
    that its first id lies in."""
    j = blk.select("at", F.concat("ids", F.slice("ahead", 1, n - 1)).alias("_s"))
    at = F.sequence(F.lit(n - 1), F.size("_s") - 1)
    ex = j.where(F.size("_s") >= n).select("at", "_s", F.explode(at).alias("_i"))
    return ex.select((F.col("at") + F.col("_i")).alias("pos"),
                     context_key([F.get("_s", F.col("_i") - (n - 1 - k)) for k in range(n - 1)], vocab_size)
                     .alias("ctx"),
                     F.get("_s", F.col("_i")).alias("nxt"))


def ngram_candidates(counts: DataFrame) -> DataFrame:
    """T13 -> T10-T12: the continuations of a context as candidates (ctx,
    token, logit), logit the log count."""
    return counts.select("ctx", F.col("nxt").alias("token"), F.ln("n").alias("logit"))


#: Rows a task adds up.
ROWS_A_TASK = 1_000_000


def count_parts(spark, rows: int) -> int:
    """Tasks for the sums of so many rows; a task's share does not grow."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_TASK))


def _summed(rows: DataFrame, parts: int | None) -> DataFrame:
    """(ctx, nxt, n) with the numbers of equal (ctx, nxt) added up.  Long n-grams
    seldom repeat: with ``parts``, rows move as they are and so many tasks add
    them up, so no table of sums grows with the rows that a task reads."""
    if parts:
        rows = rows.repartition(parts, "ctx", "nxt")
    return rows.groupBy("ctx", "nxt").agg(F.sum("n").cast("long").alias("n"))


def ngram_counts(pairs: DataFrame, parts: int | None = None) -> DataFrame:
    """T13 (fit): counts of (ctx, nxt), whatever the order."""
    return _summed(pairs.select("ctx", "nxt", F.lit(1).alias("n")), parts)


def lower_order(counts: DataFrame, blk: DataFrame, n: int, vocab_size: int,
                parts: int | None = None) -> DataFrame:
    """Counts of order n - 1 from those of order ``n`` (contexts of one
    long), so the tokens are not read again: the oldest id leaves the
    context and equal ones are added.  Position n - 2, the only one with a
    context of n - 2 ids and none of n - 1, comes from the first block."""
    bits = id_bits(vocab_size)
    if (n - 1) * bits > 63 or n < 3:
        raise ValueError(f"order {n} has no shorter context of one long")
    less = counts.select(F.col("ctx").bitwiseAND(F.lit((1 << (n - 2) * bits) - 1)).alias("ctx"), "nxt", "n")
    first = blk.where((F.col("blk") == 0) & (F.size("ids") > n - 2)).select(
        context_key([F.get("ids", F.lit(k)) for k in range(n - 2)], vocab_size).alias("ctx"),
        F.get("ids", F.lit(n - 2)).alias("nxt"), F.lit(1).cast("long").alias("n"))
    return _summed(less.unionByName(first), parts)


def ngram_token_losses(counts: DataFrame, eval_pairs: DataFrame, alpha: float,
                       vocab_size: int) -> DataFrame:
    """T13 (score): per-token cross-entropy -ln((c + a) / (t + a V)) with
    add-alpha smoothing; unseen contexts give -ln(1 / V)."""
    totals = counts.groupBy("ctx").agg(F.sum("n").alias("_t"))
    j = (eval_pairs.join(counts, ["ctx", "nxt"], "left")
         .join(totals, "ctx", "left"))
    c = F.coalesce("n", F.lit(0)).cast("double")
    t = F.coalesce("_t", F.lit(0)).cast("double")
    return j.withColumn("loss", -F.log((c + alpha) / (t + alpha * vocab_size))) \
        .drop("n", "_t")
