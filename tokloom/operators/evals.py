"""Evaluation statistics.

Samples arrive as a flat table (task_id, sample_id, completion, passed);
nesting happens only at a sink.  Nothing is executed: pass/fail is data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokloom.config import PASS_AT_K
from tokloom.functions.stats import pass_at_k, perplexity
from tokloom.functions.text import cut_at_blank_line


def correct_per_task(samples: DataFrame, task: str = "task_id",
                     passed: str = "passed") -> DataFrame:
    """Samples and correct samples per task."""
    return samples.groupBy(task).agg(
        F.count(F.lit(1)).cast("long").alias("n_samples"),
        F.sum(F.col(passed).cast("int")).cast("long").alias("n_correct"))


def pass_at_k_table(per_task: DataFrame, ks=PASS_AT_K, task: str = "task_id") -> DataFrame:
    """F12 per (task, k); k larger than a task's sample count is skipped."""
    kk = F.explode(F.array(*[F.lit(k) for k in ks])).alias("k")
    t = per_task.select(task, "n_samples", "n_correct", kk)
    t = t.where(F.col("k") <= F.col("n_samples"))
    return t.withColumn("pass_at_k", pass_at_k(F.col("n_samples"), F.col("n_correct"), F.col("k")))


def mean_pass_at_k(per_task: DataFrame, ks=PASS_AT_K) -> DataFrame:
    """Mean over tasks of pass@k, per k."""
    return (pass_at_k_table(per_task, ks).groupBy("k")
            .agg(F.avg("pass_at_k").alias("pass_at_k"),
                 F.count(F.lit(1)).cast("long").alias("n_tasks")))


def completion_text(prompt, completion):
    """P12 + P13: completion cut at its first blank line, appended to the
    prompt."""
    cut = cut_at_blank_line(completion)
    return cut, F.concat(prompt if not isinstance(prompt, str) else F.col(prompt), cut)


def validity_rate(df: DataFrame, ok_col: str, group: list[str]) -> DataFrame:
    """Share of rows whose verdict is true per group (a null verdict is
    not; 0.0 when there is none)."""
    ok = F.coalesce(F.col(ok_col), F.lit(False)).cast("int")
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).cast("long").alias("n_total"), F.sum(ok).cast("long").alias("n_valid"),
        F.coalesce(F.avg(ok.cast("double")), F.lit(0.0)).alias("pass_rate"))


def mean_loss(losses: DataFrame, max_batches: int | None, weight: str = "batch",
              batch_col: str = "batch_id", loss_col: str = "loss") -> DataFrame:
    """A10: mean loss over the first ``max_batches`` batches.

    weight="batch": mean of per-batch means (a short last batch weighs as
    much as a full one); weight="token": mean over all rows.  Null when
    there is nothing to average."""
    src = losses if not max_batches else losses.where(F.col(batch_col) < max_batches)
    if weight == "token":
        return src.agg(F.avg(loss_col).alias("loss"),
                       F.count(F.lit(1)).cast("long").alias("n"))
    per = src.groupBy(batch_col).agg(F.avg(loss_col).alias("_bl"))
    return per.agg(F.avg("_bl").alias("loss"), F.count(F.lit(1)).cast("long").alias("n"))


def with_perplexity(df: DataFrame, loss_col: str = "loss") -> DataFrame:
    """exp(loss), infinity from loss 300 on."""
    return df.withColumn("perplexity", perplexity(F.col(loss_col)))


def expand_samples(problems: DataFrame, n_samples: int, task: str = "task_id") -> DataFrame:
    """One row per (problem, sample index)."""
    return problems.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1)))
                           .alias("sample_id"))


def progress(per_task: DataFrame, order: str = "task_id") -> DataFrame:
    """Position of each problem among all (1-based), the total, and its
    pass@1.  Position comes from the distributed running count; the total
    is one aggregate."""
    from tokloom.operators.ordered import running_sums
    total = per_task.count()
    ranked = running_sums(per_task, [order], {"position": F.lit(1).cast("long")},
                          inclusive=True)
    return ranked.withColumn("total", F.lit(total).cast("long")).withColumn(
        "pass_at_1", pass_at_k(F.col("n_samples"), F.col("n_correct"), F.lit(1)))


def mean_loss_multi(losses: DataFrame, max_batches: list[int], weight: str = "batch",
                    batch_col: str = "batch_id", loss_col: str = "loss") -> DataFrame:
    """A10 for several ``max_batches`` values in one pass: per-batch sums
    and counts are aggregated once (partial/final), then each limit reads
    that per-batch table (one row per batch)."""
    per = losses.groupBy(batch_col).agg(F.sum(loss_col).alias("_s"),
                                        F.count(F.lit(1)).alias("_c"))
    lim = per.select("*", F.explode(F.array(*[F.lit(m) for m in max_batches])).alias("max_batches"))
    lim = lim.where((F.col("max_batches") <= 0) | (F.col(batch_col) < F.col("max_batches")))
    if weight == "token":
        val = F.sum("_s") / F.sum("_c")
        n = F.sum("_c")
    else:
        val = F.avg(F.col("_s") / F.col("_c"))
        n = F.count(F.lit(1))
    return lim.groupBy("max_batches").agg(val.alias("loss"), n.cast("long").alias("n"))
