"""Table sources (S5-S12) and the mapping of the driver's tables onto
corpus concepts."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokloom.config import LANG_TO_EXT
from tokloom.functions.text import padded_name

EVAL_PROBLEM_SCHEMA = T.StructType([
    T.StructField("task_id", T.StringType()),
    T.StructField("prompt", T.StringType()),
    T.StructField("test", T.StringType()),
    T.StructField("entry_point", T.StringType()),
])

META_SCHEMA = T.StructType([
    T.StructField("vocab_size", T.LongType()),
    T.StructField("total_tokens", T.LongType()),
    T.StructField("train_tokens", T.LongType()),
    T.StructField("val_tokens", T.LongType()),
    T.StructField("val_ratio", T.DoubleType()),
    T.StructField("dtype", T.StringType()),
    T.StructField("tokenizer", T.StringType()),
    T.StructField("total_files", T.LongType()),
    T.StructField("skipped_files", T.LongType()),
    T.StructField("ext_counts", T.MapType(T.StringType(), T.LongType())),
])


#: Per-row work on these (regex, hashing, tokenising) is CPU-bound.
TEXT_TABLES = ("documents", "pages", "conversations", "benchmark")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  A text table in fewer files than the cluster has
    cores is dealt out evenly (no key, so no key can be hot); a table of many
    files is read as it lies."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name in TEXT_TABLES and len(df.inputFiles()) < cores:
        return df.repartition(cores)
    return df


def lang_ext(lang_col="lang"):
    expr = None
    for lang, ext in LANG_TO_EXT.items():
        cond = F.col(lang_col) == lang
        expr = F.when(cond, ext) if expr is None else expr.when(cond, ext)
    return expr.otherwise(".txt")


def code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` seen as a tree of code files.

    path = source/<8-digit doc_id><ext>, ext from the language, size in
    UTF-8 bytes.  Columns: doc_id, path, ext, lang, source, n_bytes, text.
    """
    d = load(spark, sf_dir, "documents")
    ext = lang_ext("lang")
    return d.select(
        "doc_id",
        F.concat(F.col("source"), F.lit("/"), padded_name(F.col("doc_id"), ext)).alias("path"),
        ext.alias("ext"), "lang", "source",
        F.octet_length("text").cast("long").alias("n_bytes"),
        "text")


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet",
                content_col: str = "content", index_col: str = "idx", schema=None) -> DataFrame:
    """Single-corpus scan with its source index; a missing content value
    reads as ''."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path).select(index_col, F.coalesce(F.col(content_col), F.lit("")).alias("content"))


def read_multilang(spark: SparkSession, path: str, langs: dict[str, str],
                   fmt: str = "parquet", index_col: str = "idx") -> DataFrame:
    """One scan for every language of ``langs`` (language -> extension, in
    rank order): language, lang_rank, idx, ext, content.  Ordered by
    (lang_rank, idx) one quota runs on across the languages."""
    df = spark.read.format(fmt).load(path)
    code = F.coalesce(*[F.col(c) for c in ("code", "content") if c in df.columns], F.lit(""))
    names = F.array(*[F.lit(x) for x in langs])
    exts = F.array(*[F.lit(x) for x in langs.values()])
    rank = F.array_position(names, F.col("language")).cast("int")
    return (df.select("language", (rank - 1).alias("lang_rank"), index_col,
                      F.get(exts, rank - 1).alias("ext"), code.alias("content"))
            .where("lang_rank >= 0"))


def read_jsonl(spark: SparkSession, path: str, schema=EVAL_PROBLEM_SCHEMA) -> DataFrame:
    """JSON lines with a fixed schema (gzip read natively); blank
    lines produce no row."""
    return spark.read.schema(schema).json(path)


def read_prompts(spark: SparkSession, path: str | None,
                 defaults: list[str]) -> DataFrame:
    """One prompt per line, stripped, blanks dropped; the given
    default prompts when no file is named."""
    from tokloom.functions.text import py_strip
    if path is None:
        return spark.createDataFrame([(p,) for p in defaults], "prompt string")
    df = spark.read.text(path).select(py_strip("value").alias("prompt"))
    return df.where(F.length("prompt") > 0)


def read_shards(spark: SparkSession, path: str, split: str,
                block_size: int) -> DataFrame:
    """One split of the token-shard table (partition pruning on
    ``split``); fails when the split has too few tokens for one window."""
    df = spark.read.parquet(path).where(F.col("split") == split)
    size = F.col("n_tokens") if "n_tokens" in df.columns else F.size("ids")  # packed ids carry their number
    n = df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    if n <= block_size:
        raise ValueError(f"{split!r} holds {n} tokens; one window of {block_size} takes {block_size + 1}")
    return df


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    """Metadata summary row."""
    return spark.read.schema(META_SCHEMA).option("multiLine", "true").json(path)


def first_readable(spark: SparkSession, candidates, fmt: str = "parquet"):
    """First candidate whose schema resolves, else None (warned)."""
    import warnings
    for path in candidates:
        try:
            df = spark.read.format(fmt).load(path)
            df.schema  # noqa: B018 - resolves the source
            return df
        except AnalysisException as exc:
            warnings.warn(f"source {path!r} unreadable: {exc.__class__.__name__}")
    return None


def union_sources(frames: dict[str, DataFrame]) -> DataFrame:
    """Union by name, a ``dataset`` column naming each source."""
    tagged = [df.withColumn("dataset", F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def read_function_pairs(spark: SparkSession, path: str, fmt: str = "parquet",
                        doc_col: str = "func_documentation_string",
                        code_col: str = "whole_func_string") -> DataFrame:
    """function/docstring pairs composed into one document (P9); a
    missing value reads as ''."""
    from tokloom.functions.text import compose_doc
    df = spark.read.format(fmt).load(path)
    d = F.coalesce(F.col(doc_col), F.lit(""))
    c = F.coalesce(F.col(code_col), F.lit(""))
    cols = [x for x in df.columns if x not in (doc_col, code_col)]
    return df.select(*cols, compose_doc(d, c).alias("content"))
