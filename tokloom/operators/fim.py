"""Fill-in-the-middle rearrangement and collation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokloom.config import FIM_RATE, FIM_TEXT_MARKERS, LABEL_PAD, SPM_RATE
from tokloom.functions.hashing import uniform, uniform_int


def fim_ids(ids: Column, key: Column, seed: int, prefix_id: int, suffix_id: int,
            middle_id: int, eos_id: int, spm_rate: float = SPM_RATE) -> Column:
    """T6 on one sequence.  Fewer than 6 ids pass through; otherwise cut
    points a in [1, n-2], b in [a+1, n-1] split prefix/middle/suffix and
    the parts are laid out SPM or PSM with three markers and a final eos."""
    n = F.size(ids)
    # bounds stay valid for short inputs (those pass through unchanged)
    a = uniform_int(F.lit(1), F.greatest(n - 2, F.lit(1)), seed, key, 1)
    b = uniform_int(a + 1, F.greatest(n - 1, a + 1), seed, key, 2)
    return F.when(n < 6, ids).otherwise(
        _laid_out(ids, a, b, uniform(seed, key, 3) < spm_rate, prefix_id, suffix_id, middle_id, eos_id))


def _laid_out(ids: Column, a: Column, b: Column, is_spm: Column, prefix_id: int, suffix_id: int,
              middle_id: int, eos_id: int) -> Column:
    n = F.size(ids)
    pre = F.slice(ids, 1, a)
    mid = F.slice(ids, a + 1, F.greatest(b - a, F.lit(0)))
    suf = F.slice(ids, b + 1, F.greatest(n - b, F.lit(0)))
    P, S, M, E = (F.array(F.lit(x)) for x in (prefix_id, suffix_id, middle_id, eos_id))
    spm = F.concat(S, suf, P, pre, M, mid, E)
    psm = F.concat(P, pre, S, suf, M, mid, E)
    return F.when(is_spm, spm).otherwise(psm)


def fim_samples(samples: DataFrame, seed: int, prefix_id: int, suffix_id: int,
                middle_id: int, eos_id: int, key: str = "win_id", x_col: str = "x",
                fim_rate: float = FIM_RATE, spm_rate: float = SPM_RATE) -> DataFrame:
    """Per sample: FIM with probability ``fim_rate`` (coin from the
    portable hash), then input = s[:-1], label = s[1:] (shifted once)."""
    k, x = F.col(key), F.col(x_col)
    n = F.size(x)
    # the cut points of ``fim_ids`` as columns: each is hashed once a sample
    cut = (samples.withColumn("_fim_a", F.when((uniform(seed, k, 0) < fim_rate) & (n >= 6),
                                           uniform_int(F.lit(1), F.greatest(n - 2, F.lit(1)), seed, k, 1)))
           .withColumn("_fim_b", uniform_int(F.col("_fim_a") + 1, F.greatest(n - 1, F.col("_fim_a") + 1), seed, k, 2))
           .withColumn("_fim_spm", F.when(F.col("_fim_a").isNotNull(), uniform(seed, k, 3) < spm_rate)))
    s = F.when(F.col("_fim_a").isNull(), x).otherwise(
        _laid_out(x, F.col("_fim_a"), F.col("_fim_b"), F.col("_fim_spm"), prefix_id, suffix_id, middle_id, eos_id))
    n = F.size("_s")
    return (cut.withColumn("_s", s)
            .withColumn("input_ids", F.slice("_s", 1, n - 1))
            .withColumn("labels", F.slice("_s", 2, n - 1))
            .drop("_s", "_fim_a", "_fim_b", "_fim_spm"))


def collate(batch_rows: DataFrame, pad_id: int, batch_col: str = "batch_id") -> DataFrame:
    """Right-pad inputs with ``pad_id`` and labels with -100 to the
    batch maximum; the attention mask comes from the true length, so a real
    pad id inside the text stays visible.  The max is a window over one
    batch (at most batch_size rows)."""
    w = Window.partitionBy(batch_col)
    ln = F.size("input_ids")
    mx = F.max(ln).over(w)
    pad = mx - ln
    return batch_rows.select(
        "*",
        F.concat("input_ids", F.array_repeat(F.lit(pad_id), pad)).alias("_in"),
        F.concat("labels", F.array_repeat(F.lit(LABEL_PAD), pad)).alias("_lb"),
        F.concat(F.array_repeat(F.lit(1), ln), F.array_repeat(F.lit(0), pad))
        .alias("attention_mask"),
    ).drop("input_ids", "labels").withColumnRenamed("_in", "input_ids") \
        .withColumnRenamed("_lb", "labels")


def fim_prompt(prefix: Column, suffix: Column) -> Column:
    """Text form <fim_prefix>P<fim_suffix>S<fim_middle>."""
    return F.concat(F.lit(FIM_TEXT_MARKERS[0]), prefix, F.lit(FIM_TEXT_MARKERS[1]), suffix,
                    F.lit(FIM_TEXT_MARKERS[2]))
