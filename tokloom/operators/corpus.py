"""Corpus filters, quotas and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokloom.config import EXT_TO_TAG, FIM_TEXT_MARKERS, SPECIALS
from tokloom.functions.text import compose_doc, path_parts, py_strip
from tokloom.operators.ordered import running_sums


def strip_nonempty(df: DataFrame, text_col: str = "text",
                   out_col: str | None = None) -> DataFrame:
    """Strip like Python ``str.strip`` and drop rows left empty."""
    out_col = out_col or text_col
    return (df.withColumn(out_col, py_strip(text_col))
            .where(F.length(out_col) > 0))


def ext_histogram(files: DataFrame) -> DataFrame:
    """A2: files per extension."""
    return files.groupBy("ext").agg(F.count(F.lit(1)).alias("n_files"))


def top_extensions(files: DataFrame, n: int = 15) -> DataFrame:
    """A2 as it is reported: the ``n`` most frequent extensions."""
    return ext_histogram(files).orderBy(F.desc("n_files"), "ext").limit(n)


def ext_counts_map(files: DataFrame) -> DataFrame:
    """A2 as one MAP<ext, count> row (metadata form)."""
    h = ext_histogram(files)
    return h.agg(F.map_from_entries(
        F.array_sort(F.collect_list(F.struct("ext", "n_files")))).alias("ext_counts"))


def corpus_totals(files: DataFrame, text_col: str = "text") -> DataFrame:
    """A1 + P5: files, bytes and the files skipped as undecodable/blank,
    all in one aggregate."""
    stripped = py_strip(text_col)
    skipped = F.col(text_col).isNull() | (F.length(stripped) == 0)
    return files.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.coalesce(F.sum("n_bytes"), F.lit(0)).cast("long").alias("total_bytes"),
        F.sum(F.when(skipped, 1).otherwise(0)).cast("long").alias("skipped_files"))


def take_until(df: DataFrame, order: list, size_col: str,
               max_files: int | None, max_bytes: float | None,
               group: list[str] = ()) -> DataFrame:
    """Running quota.  Rows are written in ``order``; the check runs
    after each write, so a row is kept while the rows and bytes written
    *before* it are both under their limits (the crossing row is kept).
    0 or None disables a limit.  Budgets are per ``group``."""
    out = running_sums(df, order, {"_files_before": F.lit(1).cast("long"),
                                   "_bytes_before": F.col(size_col).cast("long")},
                       group=group)
    cond = F.lit(True)
    if max_files:
        cond = cond & (F.col("_files_before") < max_files)
    if max_bytes:
        cond = cond & (F.col("_bytes_before") < max_bytes)
    return out.where(cond).drop("_files_before", "_bytes_before")


def take_until_files(spark: SparkSession, files: list[str], schema, rows, order: list, size_col: str,
                     max_files: int | None, max_bytes: float | None) -> tuple[DataFrame, int]:
    """W2 over files in source order, and how many files were opened.

    Files are opened in growing prefixes (1, 2, 4, ...) until the running
    quota cuts a row: what lies behind the crossing row is never read, and
    what is read twice is less than what is read once.  ``rows`` maps the
    files' rows to those that count; ``order`` sorts inside a file."""
    place = F.array_position(F.array(*[F.lit(f.rsplit("/", 1)[-1]) for f in files]),
                             F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    n = 1
    while True:
        n = min(n, len(files))
        opened = rows(spark.read.schema(schema).parquet(*files[:n]).withColumn("_place", place))
        sums = opened.agg(F.count(F.lit(1)).alias("n"), F.sum(size_col).alias("b")).first()
        full = (max_files and sums["n"] > max_files) or (max_bytes and (sums["b"] or 0) > max_bytes)
        if full or n == len(files):
            return take_until(opened, ["_place", *order], size_col, max_files, max_bytes).drop("_place"), n
        n *= 2


def composed_pairs(turns: DataFrame) -> DataFrame:
    """P9 over a conversation table: each user turn followed by an
    assistant turn becomes one document ``\"\"\"\\nuser\\n\"\"\"\\nassistant``.

    Consecutive turns meet through an equi-join on (conv_id, turn + 1),
    so a very long conversation is spread over many tasks instead of
    landing in one window partition.
    """
    u = turns.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("doc"))
    a = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("code"))
    return (u.join(a, ["conv_id", "turn"])
            .select("conv_id", "turn", compose_doc("doc", "code").alias("content")))


def specials_df(spark: SparkSession) -> DataFrame:
    """The special-token vocabulary: ids 0..14 in configuration order."""
    return spark.createDataFrame(
        [(i, t, True) for i, t in enumerate(SPECIALS)],
        "id int, token string, is_special boolean")


def tag_table(spark: SparkSession, ext_to_tag: dict = EXT_TO_TAG) -> DataFrame:
    return spark.createDataFrame(list(ext_to_tag.items()), "ext string, tag string")


def lookup_ids(df: DataFrame, token_col: str, vocab: DataFrame,
               out_col: str, unk_id: int | None = 0) -> DataFrame:
    """Token -> id through a left join on the vocabulary, with the
    unknown id as fallback.  The vocabulary is bounded by its configured
    size, so it is broadcast."""
    v = vocab.select(F.col("token").alias("_tok"), F.col("id").alias("_id"))
    j = df.join(F.broadcast(v), F.col(token_col) == F.col("_tok"), "left")
    fill = F.col("_id") if unk_id is None else F.coalesce("_id", F.lit(unk_id))
    out = j.withColumn(out_col, F.when(F.col(token_col).isNotNull(), fill))
    return out.drop("_tok", "_id")


def tag_ids(files: DataFrame, vocab: DataFrame, unk_id: int = 0) -> DataFrame:
    """Language tag id per file; null when the extension has no tag or
    the tag is unknown to the vocabulary (no ``<unk>`` is injected)."""
    spark = files.sparkSession
    tags = tag_table(spark)
    j = files.join(F.broadcast(tags), "ext", "left")
    j = lookup_ids(j, "tag", vocab, "tag_id", unk_id=unk_id)
    return j.withColumn("tag_id", F.when(F.col("tag_id") != unk_id, F.col("tag_id")))


def missing_tokens(wanted: DataFrame, vocab: DataFrame) -> DataFrame:
    """Wanted tokens not yet in the vocabulary (left anti join)."""
    return wanted.join(vocab.select("token"), "token", "left_anti")


def ordered_files(files: DataFrame) -> DataFrame:
    """O1: path order compares path parts, not raw strings."""
    return files.orderBy(path_parts("path"))


def row_index(df: DataFrame, order: list, group: list[str] = ()) -> DataFrame:
    """Dense 0-based index in source order (per group), computed with
    the distributed running count, never with a single-task window."""
    return running_sums(df, order, {"idx": F.lit(1).cast("long")}, group=group)


def special_tokens(core=None, extra=None, drop=None) -> list[str]:
    """Ordered union of core and extra specials (first occurrence
    wins), minus ``drop``; the list is a configuration value."""
    from tokloom.config import CORE_SPECIALS, EXTRA_SPECIALS
    seen, out = set(drop or ()), []
    for t in list(core or CORE_SPECIALS) + list(extra or EXTRA_SPECIALS):
        if t not in seen:
            seen.add(t)
            out.append(t)
    return out


def marker_ids(vocab: DataFrame) -> dict[str, int]:
    """Ids of the FIM markers and the end-of-text token in a vocabulary
    (id, token).  An unknown marker is an error; without its own token the
    end of text is ``<eos>``."""
    wanted = [*FIM_TEXT_MARKERS, "<|endoftext|>", "<eos>"]
    found = {r["token"]: r["id"] for r in vocab.where(F.col("token").isin(wanted)).collect()}
    unknown = [t for t in FIM_TEXT_MARKERS if t not in found]
    if unknown or "<eos>" not in found:
        raise ValueError(f"not in the vocabulary: {', '.join(unknown) or '<eos>'}")
    return {**{t: found[t] for t in FIM_TEXT_MARKERS}, "eos": found["<eos>"],
            "eot": found.get("<|endoftext|>", found["<eos>"])}


def resolve_id(explicit, vocab_id, default: int = 0):
    """Explicit id, else the vocabulary's id, else the default (an
    explicit 0 also falls through, as a falsy value)."""
    from pyspark.sql import Column
    def lit(x):
        return x if isinstance(x, Column) else F.lit(x)
    e = lit(explicit) if explicit is not None else F.lit(None)
    v = lit(vocab_id) if vocab_id is not None else F.lit(None)
    pick_e = F.when(e.isNotNull() & (e != 0), e)
    pick_v = F.when(v.isNotNull() & (v != 0), v)
    return F.coalesce(pick_e, pick_v, F.lit(default)).cast("int")
