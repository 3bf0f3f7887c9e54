"""Run-log rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokloom.operators.ordered import running_sums


def step_rollup(log: DataFrame, accum: int, log_every: int, run: str = "run_id",
                raw_step: str = "raw_step") -> DataFrame:
    """Micro-batches are counted from 1 in each run and ``accum`` of them
    make one optimizer step; report, every ``log_every`` whole steps, the last
    micro-batch's loss and the step's tokens."""
    nth = running_sums(log, [raw_step], {"_nth": F.lit(1).cast("long")}, group=[run],
                       inclusive=True)
    s = nth.withColumn("step", F.ceil(F.col("_nth") / accum))
    g = s.groupBy(run, "step").agg(
        F.max_by("loss", raw_step).alias("loss"),
        F.count(F.lit(1)).cast("long").alias("n_micro"),
        F.sum("tokens").cast("long").alias("tokens"))
    return g.where((F.col("n_micro") == accum) & (F.col("step") % log_every == 0))


def throughput(log: DataFrame, run: str = "run_id", raw_step: str = "raw_step") -> DataFrame:
    """Tokens so far and tokens per second since the run's first row."""
    cum = running_sums(log, [raw_step], {"tokens_so_far": F.col("tokens").cast("long")},
                       group=[run], inclusive=True)
    start = log.groupBy(run).agg(F.min("ts").alias("_t0"))
    j = cum.join(start, run)
    el = (F.unix_micros(F.col("ts").cast("timestamp")) -
          F.unix_micros(F.col("_t0").cast("timestamp"))) / F.lit(1e6)
    return j.withColumn("elapsed_s", el).withColumn(
        "tok_per_s", F.when(F.col("elapsed_s") > 0, F.col("tokens_so_far") / F.col("elapsed_s"))
    ).drop("_t0")


def newest_n(manifest: DataFrame, n: int, group: str = "run_id",
             step: str = "step") -> DataFrame:
    """Keep the newest ``n`` entries per group (n = 0 keeps all).
    The row-number filter lets Catalyst apply a partial group limit before
    the shuffle."""
    if not n:
        return manifest
    w = Window.partitionBy(group).orderBy(F.desc(step))
    return manifest.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
