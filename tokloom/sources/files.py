"""File-tree sources.

Discovery reads only file metadata: ``binaryFile`` prunes ``content`` when
it is not selected and pushes ``length`` predicates into the listing, so
size and path filters run before a single byte of content is read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokloom.config import CODE_EXTENSIONS, MAX_FILE_BYTES, CorpusConfig
from tokloom.functions.text import (excluded_glob, excluded_substring,
                                    normalize_newlines, suffix)


def _listing(spark: SparkSession, raw_dir: str) -> DataFrame:
    return (spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(raw_dir))


def file_filter(path_col: str, size_col: str, cfg: CorpusConfig):
    """P1 (extension), P2 (exclusion) and P3 (inclusive size range)."""
    exts = [e.lower() for e in cfg.extensions]
    cond = suffix(path_col).isin(exts)
    if cfg.exclude_patterns:
        if cfg.exclude_mode == "glob":
            cond = cond & ~excluded_glob(path_col, cfg.exclude_patterns)
        else:
            cond = cond & ~excluded_substring(path_col, cfg.exclude_patterns)
    lo = cfg.min_bytes or 0
    hi = cfg.max_bytes
    size = F.col(size_col)
    cond = cond & (size >= lo)
    if hi is not None:
        cond = cond & (size <= hi)
    return cond


def below(path_col: str, raw_dir: str):
    """The part of a listed path below ``raw_dir``: folders above it are not
    the corpus's own and must not exclude it."""
    root = raw_dir.split("://", 1)[-1].removeprefix("file:").strip("/")
    return F.element_at(F.split(F.col(path_col), re.escape("/" + root + "/"), 2), -1)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df``, or an error when it has no row."""
    if df.isEmpty():
        raise ValueError(f"no {what} found")
    return df


def discover_files(spark: SparkSession, raw_dir: str,
                   cfg: CorpusConfig = CorpusConfig()) -> DataFrame:
    """(path, ext, n_bytes) of every file passing P1-P3.

    Order is not imposed here; consumers order by ``path_parts(path)``
    (O1) only where order matters.
    """
    df = _listing(spark, raw_dir).select(
        F.col("path"), F.col("length").alias("n_bytes"))
    return (df.withColumn("_rel", below("path", raw_dir))
            .where(file_filter("_rel", "n_bytes", cfg))
            .select("path", suffix("path").alias("ext"), "n_bytes"))


#: The vocabulary-learning walk has fixed extensions, no minimum size and
#: no exclusions.
TOKENIZER_WALK = CorpusConfig(extensions=CODE_EXTENSIONS, exclude_patterns=(),
                              min_bytes=0, max_bytes=MAX_FILE_BYTES)


def tokenizer_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    """The files vocabulary learning reads; an error when there are none."""
    return require_rows(discover_files(spark, raw_dir, TOKENIZER_WALK), "files to learn from")


def read_code_files(spark: SparkSession, raw_dir: str,
                    cfg: CorpusConfig = CorpusConfig()) -> DataFrame:
    """S1 + S3: discovered files with their strictly decoded text.

    ``valid`` is false for content that is not UTF-8; such files keep a
    null ``text`` so they can be counted as skipped (P5).
    """
    df = _listing(spark, raw_dir)
    df = df.withColumn("_rel", below("path", raw_dir)).where(file_filter("_rel", "length", cfg))
    raw = F.col("content").cast("string")
    valid = F.is_valid_utf8(raw)
    return df.select(
        "path", suffix("path").alias("ext"), F.col("length").alias("n_bytes"),
        valid.alias("valid"),
        F.when(valid, normalize_newlines(raw)).alias("text"))


def read_text_lines(spark: SparkSession, raw_dir: str, cfg: CorpusConfig = TOKENIZER_WALK) -> DataFrame:
    """Lossy decode (invalid bytes -> U+FFFD), one row per line.  One
    listing, filtered before content is read; no shuffle."""
    df = _listing(spark, raw_dir).where(file_filter("path", "length", cfg))
    text = F.make_valid_utf8(F.col("content").cast("string"))
    return df.select("path", F.posexplode(F.split(normalize_newlines(text), "\n"))
                     .alias("line_no", "line"))
