"""Catalogue queries over sources and sinks (S5-S11, K1, K3, K5, K6): each
writes a driver table in the form a source expects, or through a sink, and
reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokloom.config import LANG_TO_EXT, CorpusConfig
from tokloom.operators import corpus as C
from tokloom.operators import evals as E
from tokloom.plans.corpus_queries import discovered
from tokloom.plans.eval_queries import samples
from tokloom.plans.stream_queries import q_meta_row
from tokloom.session import scratch
from tokloom.sources import files as FS
from tokloom.sources import sinks as K
from tokloom.sources import tables as T

LANGUAGE_BYTES = 1_000_000


def q_quota_languages(spark, sf):
    """S6 + W2: one byte budget running on across the languages in rank
    order, in source order inside each."""
    out = scratch(spark, "multilang")
    T.load(spark, sf, "documents").select(
        F.col("lang").alias("language"), F.col("doc_id").alias("idx"),
        F.col("text").alias("content")).write.parquet(out)
    rows = C.strip_nonempty(T.read_multilang(spark, out, LANG_TO_EXT), "content").select(
        "language", "lang_rank", "idx", F.octet_length("content").cast("long").alias("n_bytes"))
    return C.take_until(rows, ["lang_rank", "idx"], "n_bytes", None, LANGUAGE_BYTES).select(
        "language", "idx", "n_bytes")


def q_corpus_scan(spark, sf):
    out = scratch(spark, "corpus")
    T.load(spark, sf, "documents").select(
        F.col("doc_id").alias("idx"), F.col("text").alias("content")).write.parquet(out)
    rows = C.strip_nonempty(T.read_corpus(spark, out), "content")
    return rows.select("idx", F.length("content").alias("n_chars"))


def q_documents_sink(spark, sf):
    out = scratch(spark, "documents")
    docs = T.code_files(spark, sf).select(
        F.col("source").alias("dataset"), "lang", F.col("doc_id").alias("idx"), "ext", "text")
    K.write_documents(docs, out)
    return spark.read.parquet(out).select("dataset", "lang", "idx", "path",
                                          F.length("text").alias("n_chars"))


def q_jsonl_scan(spark, sf):
    """S8, gzip included."""
    out = scratch(spark, "jsonl")
    T.load(spark, sf, "benchmark").select(
        F.col("item_id").cast("string").alias("task_id"), F.col("text").alias("prompt")
    ).write.option("compression", "gzip").json(out)
    return T.read_jsonl(spark, out).select("task_id", "prompt")


def q_prompts_scan(spark, sf):
    out = scratch(spark, "prompts")
    T.load(spark, sf, "benchmark").select(F.col("text").alias("value")).write.text(out)
    return T.read_prompts(spark, out, []).groupBy("prompt").agg(F.count(F.lit(1)).alias("n"))


def q_function_pairs(spark, sf):
    out = scratch(spark, "pairs")
    t = T.load(spark, sf, "conversations")
    u = t.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("func_documentation_string"))
    a = t.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"),
                                             F.col("text").alias("whole_func_string"))
    u.join(a, ["conv_id", "turn"]).write.parquet(out)
    return T.read_function_pairs(spark, out)


def q_meta_sink(spark, sf):
    """K3 with all ten keys, read back by S11."""
    out = scratch(spark, "meta")
    meta = q_meta_row(spark, sf).drop("ext_counts").withColumn("tokenizer", F.lit("word-hash"))
    # one row each: keyed together, not crossed
    one = F.lit(1).alias("one")
    both = meta.select("*", one).join(C.ext_counts_map(discovered(spark, sf)).select("*", one), "one")
    K.write_meta(both.drop("one"), out)
    back = T.read_meta(spark, out)
    pairs = F.array_sort(F.map_entries("ext_counts"))
    shown = F.array_join(F.transform(pairs, lambda e: F.concat(
        e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return back.select(*[c for c in back.columns if c != "ext_counts"], shown.alias("ext_counts"))


def q_completions_sink(spark, sf):
    """K5 in its text form, one file line per text line."""
    out = scratch(spark, "completions")
    t = T.load(spark, sf, "conversations")
    u = t.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    a = t.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), "text",
                                             F.col("turn").alias("sample_id"))
    comps = u.join(a, ["conv_id", "turn"]).select("prompt", "sample_id", "text")
    K.write_completions(comps, out)
    return K.completions_text(spark.read.parquet(f"{out}/table")).select("value")


def q_report_sink(spark, sf):
    s = samples(spark, sf)
    ppl = E.with_perplexity(T.load(spark, sf, "events").agg((F.avg("value") / 100).alias("loss")))
    report = K.eval_report(E.validity_rate(s, "passed", ["task_id"]),
                           E.mean_pass_at_k(E.correct_per_task(s)), ppl)
    out = scratch(spark, "report")
    report.coalesce(1).write.json(out)  # one row
    back = spark.read.schema("syntax string, pass_at_k string, perplexity string").json(out)

    def of(c, key):
        return F.get_json_object(c, f"$['{key}']")

    return back.select(
        of("syntax", "n_valid").cast("long").alias("n_valid"),
        of("syntax", "n_total").cast("long").alias("n_total"),
        F.round(of("syntax", "pass_rate").cast("double"), 6).alias("pass_rate"),
        F.round(of("pass_at_k", "pass@5").cast("double"), 6).alias("pass_at_5"),
        F.round(of("perplexity", "loss").cast("double"), 6).alias("loss"))


def q_top_extensions(spark, sf):
    return C.top_extensions(discovered(spark, sf))


#: Documents of a file of the written tree, and files of the ordered corpus.
TREE_DOCS, CORPUS_FILES = 100, 16
FILE_QUOTA_BYTES = 200_000
TREE = CorpusConfig(extensions=(".txt",), exclude_patterns=("lang=es",), min_bytes=2_000)


def q_quota_first_files(spark, sf):
    """W2 over files in order: the corpus as files of growing ids, of which
    those behind the crossing row are not opened."""
    out = scratch(spark, "ordered-files")
    T.load(spark, sf, "documents").select("doc_id", "text").repartitionByRange(CORPUS_FILES, "doc_id") \
        .sortWithinPartitions("doc_id").write.parquet(out)
    back = spark.read.parquet(out)
    files = sorted(back.inputFiles())

    def rows(df):
        return C.strip_nonempty(df, "text").select(
            "_place", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"))

    return C.take_until_files(spark, files, back.schema, rows, ["doc_id"], "n_bytes", None, FILE_QUOTA_BYTES)[0]


def written_tree(spark, sf):
    """Documents as a tree of text files, a folder per language and hundred
    ids; a text whose length 97 divides ends in a byte that is not UTF-8."""
    out = scratch(spark, "tree")
    bad = F.when(F.length("text") % 97 == 0, F.concat(F.col("text").cast("binary"), F.unhex(F.lit("C3"))))
    (T.load(spark, sf, "documents").select(
        "lang", F.floor(F.col("doc_id") / TREE_DOCS).alias("bucket"), "doc_id",
        F.coalesce(bad, F.col("text").cast("binary")).cast("string").alias("value"))
     .repartition("lang", "bucket").sortWithinPartitions("lang", "bucket", "doc_id").drop("doc_id")
     .write.partitionBy("lang", "bucket").text(out))
    return out


def _place_of(path):
    return [F.regexp_extract(path, "lang=([^/]+)/", 1).alias("lang"),
            F.regexp_extract(path, "bucket=([0-9]+)/", 1).cast("long").alias("bucket")]


def q_discover_tree(spark, sf):
    """The files of the tree that pass, from metadata alone."""
    return FS.discover_files(spark, written_tree(spark, sf), TREE).select(*_place_of("path"), "ext", "n_bytes")


def q_decode_tree(spark, sf):
    """S1 + S3: strictly decoded files; one bad byte spoils a file."""
    return FS.read_code_files(spark, written_tree(spark, sf), TREE).select(
        *_place_of("path"), "valid", F.length("text").cast("long").alias("n_chars"))


def q_tree_lines(spark, sf):
    """S2 + S4: lossy lines; a bad byte is one replacement character."""
    lines = FS.read_text_lines(spark, written_tree(spark, sf), TREE)
    return lines.groupBy(*_place_of("path")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).cast("long").alias("n_chars"),
        F.sum(F.length("line") - F.length(F.replace("line", F.lit("\ufffd"), F.lit("")))).cast("long").alias("n_bad"))


QUERIES = {
    "quota_first_files": q_quota_first_files,
    "discover_tree": q_discover_tree,
    "decode_tree": q_decode_tree,
    "tree_lines": q_tree_lines,
    "quota_languages": q_quota_languages,
    "corpus_scan": q_corpus_scan,
    "documents_sink": q_documents_sink,
    "jsonl_scan": q_jsonl_scan,
    "prompts_scan": q_prompts_scan,
    "function_pairs": q_function_pairs,
    "meta_sink": q_meta_sink,
    "completions_sink": q_completions_sink,
    "report_sink": q_report_sink,
    "top_extensions": q_top_extensions,
}
