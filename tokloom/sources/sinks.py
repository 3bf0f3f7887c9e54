"""Sinks (K1-K8).  Every writer is a plain DataFrame write; nothing passes
through the driver except the one-row metadata and report objects."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokloom.functions.text import padded_name
from tokloom.operators.bpe import BpeModel


def write_documents(docs: DataFrame, out: str, dataset_col: str = "dataset",
                    lang_col: str | None = "lang", idx_col: str = "idx",
                    ext_col: str = "ext", mode: str = "overwrite") -> None:
    """K1: one row per document with its would-be file name
    ``dataset[/lang]/{idx:08d}{ext}`` (idx is the *source* index, so gaps
    remain where rows were skipped), partitioned by dataset (and lang).
    Millions of tiny files are deliberately not produced."""
    parts = [F.col(dataset_col)] + ([F.col(lang_col)] if lang_col else [])
    path = F.concat_ws("/", *parts, padded_name(F.col(idx_col), F.col(ext_col)))
    by = [dataset_col] + ([lang_col] if lang_col else [])
    docs.withColumn("path", path).write.mode(mode).partitionBy(*by).parquet(out)


def write_shards(split_stream: DataFrame, out: str, mode: str = "overwrite") -> None:
    """K2: train/val token shards, one folder per split, rows sorted by
    offset inside each file (range-partitioned on offset first)."""
    (split_stream.repartitionByRange("split", "start_off")
     .sortWithinPartitions("split", "start_off")
     .write.mode(mode).partitionBy("split").parquet(out))


def write_meta(meta_row: DataFrame, out: str, mode: str = "overwrite") -> None:
    """K3: the one-row metadata table as JSON (a single small file)."""
    meta_row.coalesce(1).write.mode(mode).json(out)


def write_tokenizer(vocab: DataFrame, merges: DataFrame, out: str,
                    mode: str = "overwrite") -> None:
    """K4: vocabulary and merge tables (bounded by the vocabulary size: one
    file each)."""
    vocab.coalesce(1).write.mode(mode).parquet(f"{out}/vocab")
    merges.coalesce(1).write.mode(mode).parquet(f"{out}/merges")


def read_tokenizer(spark: SparkSession, path: str) -> BpeModel:
    """The model back from its K4 tables."""
    vocab = spark.read.parquet(f"{path}/vocab").orderBy("id").collect()
    merges = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
    return BpeModel(tokens=[r["token"] for r in vocab],
                    n_special=sum(r["is_special"] for r in vocab),
                    merges=[(r["left_id"], r["right_id"], r["merged_id"]) for r in merges])


def completions_text(comps: DataFrame, prompt: str = "prompt",
                     sample: str = "sample_id", text: str = "text") -> DataFrame:
    """K5 text form: per prompt a ``=== PROMPT: ... ===`` header followed by
    its samples, assembled per prompt (a group is one prompt's samples)."""
    g = comps.groupBy(prompt).agg(
        F.array_sort(F.collect_list(F.struct(sample, text))).alias("_s"))
    body = F.array_join(F.transform("_s", lambda z: z[text]), "\n\n")
    return g.select(prompt, F.concat(F.lit("=== PROMPT: "), F.col(prompt), F.lit(" ===\n"),
                                     body).alias("value"))


def write_completions(comps: DataFrame, out: str, mode: str = "overwrite") -> None:
    """K5: completions table plus its text rendering."""
    comps.write.mode(mode).parquet(f"{out}/table")
    completions_text(comps).select("value").write.mode(mode).text(f"{out}/text")


def eval_report(syntax: DataFrame | None, passk: DataFrame | None,
                ppl: DataFrame | None) -> DataFrame:
    """K6: one JSON string row with syntax, pass@k and perplexity blocks;
    each block is an aggregate of its (small, per-k / per-run) table."""
    parts = []
    if syntax is not None:
        parts.append(syntax.agg(F.to_json(F.struct(
            F.sum("n_valid").alias("n_valid"), F.sum("n_total").alias("n_total"),
            (F.sum("n_valid") / F.sum("n_total")).alias("pass_rate"))).alias("syntax")))
    if passk is not None:
        parts.append(passk.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(
            F.concat(F.lit("pass@"), F.col("k").cast("string")), F.col("pass_at_k")))))
            .alias("pass_at_k")))
    if ppl is not None:
        parts.append(ppl.agg(F.to_json(F.first(F.struct("loss", "perplexity"))).alias("perplexity")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    # each block contributes one row with one non-null column
    return out.agg(*[F.max(c).alias(c) for c in out.columns])


def stage_done(spark: SparkSession, path: str, min_rows: int, fmt: str = "parquet") -> bool:
    """K8: a stage is finished when its output exists with more than
    ``min_rows`` rows; reads at most min_rows + 1 rows."""
    try:
        df = spark.read.format(fmt).load(path)
    except AnalysisException:  # absent output
        return False
    return df.limit(min_rows + 1).count() > min_rows
