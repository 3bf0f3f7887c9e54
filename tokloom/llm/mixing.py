"""Mixing sources to target weights.

Tokens (here: words) are aggregated per source, each source gets a target
by capped proportional sharing, target / size is its repetition rate, and a
document is emitted floor(rate) times plus one hash-seeded Bernoulli copy
with probability equal to the fraction.  DataFrame functions only.

Sharing: sources in code point order (null last) weigh ``weights`` in turn
and share ``share`` times all tokens; a target stops at ``cap`` times the
source's size and the excess is reshared by weight until none is above.
The end state is  target = min(cap * size, level * weight)  for one level,
found from running sums over the sources ordered by cap * size / weight, so
no loop is needed and the source table may be of any length.

Defined cases: a null text has size 0 and is emitted like any other row; a
null source is a source of its own, last in order; sources of size 0 get
target 0 and no copies; a null id draws by its text alone; repeated rows
(same id and text) draw alike, equal texts with other ids independently;
an empty table gives no rows.  Other columns are carried along untouched by
``emit_mix`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokloom.llm.common import WORD, documents, join_by_size, staged
from tokloom.operators.ordered import running_sums

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column, seed: str = "mix") -> Column:
    """Uniform double in [0, 1) from the id and the text: the first 32 bits
    of an md5, the same on every run and at any partitioning."""
    key = F.concat_ws("|", F.lit(seed), doc_id.cast("string"),
                      F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def source_rates(sized: DataFrame, weights=WEIGHTS, share: float = SHARE,
                 cap: int = CAP) -> DataFrame:
    """(source, source_size, target, rate) from rows (source, size)."""
    per = staged(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = running_sums(per, [F.col("source").isNull(), F.col("source")],
                          {"rank": F.lit(1).cast("long")})
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]),
                     (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = (ranked.withColumn("w", w)
              .withColumn("most", F.col("source_size") * cap)
              .withColumn("ratio", F.col("most") / F.col("w")))
    filled = running_sums(ranked, [F.col("ratio"), F.col("rank")],
                          {"most_before": F.col("most"), "w_before": F.col("w")})
    whole = per.agg(F.sum("source_size")).first()[0] or 0
    all_w = ranked.agg(F.sum("w")).first()[0] or 0
    want = share * whole
    level = ((F.lit(want) - F.col("most_before")) / (F.lit(all_w) - F.col("w_before")))
    free = filled.where(level <= F.col("ratio"))
    row = free.agg(F.min(F.struct("ratio", "rank", level.alias("level")))).first()[0]
    top = row["level"] if row else float("inf")
    target = F.when(F.col("ratio") < F.lit(top), F.col("most").cast("double")).otherwise(
        F.lit(top) * F.col("w"))
    out = ranked.select("source", "source_size", target.alias("target"))
    rate = F.when(F.col("source_size") > 0,
                  F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return staged(out.withColumn("rate", rate), "rates")


def copies(rate: Column, u: Column) -> Column:
    return (F.floor(rate) + (u < rate - F.floor(rate)).cast("long")).cast("long")


def mix_plan(df: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP,
             seed: str = "mix") -> DataFrame:
    """One row per document: doc_id, size, source_size, target, n_copies,
    taken.  Reads the columns doc_id, text and source."""
    sized = staged(df.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                             draw(F.col("doc_id"), F.col("text"), seed).alias("u")), "sized")
    rates = source_rates(sized.select("source", "size"), weights, share, cap)
    joined = join_by_size(
        sized, rates.withColumnRenamed("source", "_source"),
        F.col("source").eqNullSafe(F.col("_source")))
    n = copies(F.col("rate"), F.col("u"))
    return joined.select("doc_id", "size", "source_size", "target", n.alias("n_copies"),
                         (n * F.col("size")).alias("taken"))


def emit_mix(df: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP,
             seed: str = "mix") -> DataFrame:
    """The mix itself: every row of ``df`` as often as the mix takes it."""
    size, u = word_count(F.col("text")), draw(F.col("doc_id"), F.col("text"), seed)
    rates = source_rates(df.select("source", size.alias("size")), weights, share, cap)
    rates = rates.select(F.col("source").alias("__mix_source"), F.col("rate").alias("__mix_rate"))
    joined = join_by_size(df, rates, F.col("source").eqNullSafe(F.col("__mix_source")))
    n = copies(F.col("__mix_rate"), u).cast("int")
    return (joined.withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(1), n)))
            .drop("__mix_source", "__mix_rate", "__mix_copy"))


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    return mix_plan(documents(spark, sf_dir, "doc_id", "text", "source"))


SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(concat_ws('|', 'mix', doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 8))::BIGINT
           / 4294967296.0::DOUBLE AS u
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, source_size * {CAP} AS most, [5, 2, 1][(rank % 3 + 1)::INT] AS w
  FROM (SELECT *, row_number() OVER (ORDER BY source IS NULL, source COLLATE C) - 1 AS rank FROM per)),
filled AS (
  SELECT *, most::DOUBLE / w AS ratio,
         coalesce(sum(most) OVER before, 0)::BIGINT AS most_before,
         coalesce(sum(w) OVER before, 0)::BIGINT AS w_before
  FROM ranked
  WINDOW before AS (ORDER BY most::DOUBLE / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT *, ({SHARE}::DOUBLE * (SELECT sum(source_size) FROM per) - most_before)
            / ((SELECT sum(w) FROM ranked) - w_before) AS level FROM filled),
top AS (SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, rank LIMIT 1),
rated AS (
  SELECT source, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate
  FROM (SELECT source, source_size,
               CASE WHEN ratio < coalesce((SELECT level FROM top), 'inf'::DOUBLE) THEN most::DOUBLE
                    ELSE (SELECT level FROM top) * w END AS target FROM filled)),
taken AS (
  SELECT doc_id, size, source_size, target,
         floor(rate)::BIGINT + (u < rate - floor(rate))::BIGINT AS n_copies
  FROM sized JOIN rated ON sized.source IS NOT DISTINCT FROM rated.source)
SELECT doc_id, size::BIGINT AS size, source_size, target::DOUBLE AS target, n_copies,
       n_copies * size AS taken FROM taken
"""
