"""Catalogue queries over the corpus operators (sections 2.1-2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokloom.config import CORE_SPECIALS, CorpusConfig, HASH_WORD_RE, SPECIALS, TREE_DIRS
from tokloom.functions.text import padded_name, path_parts, suffix
from tokloom.operators import corpus as C
from tokloom.operators.bpe import word_histogram
from tokloom.sources.files import file_filter
from tokloom.sources.tables import code_files, load, union_sources


def discovered(spark, sf, mode="substring"):
    files = code_files(spark, sf)
    cfg = CorpusConfig(exclude_mode=mode)
    return files.where(file_filter("path", "n_bytes", cfg))


def code_tree(spark, sf):
    """Documents as files of a source tree: a folder chosen by the id, and a
    few names that a rule rejects."""
    f = code_files(spark, sf)
    i = F.col("doc_id")
    folder = F.element_at(F.array(*[F.lit(d) for d in TREE_DIRS]),
                          (F.pmod(i, F.lit(len(TREE_DIRS))) + 1).cast("int"))
    ext = (F.when(i % 11 == 0, ".lock").when((F.col("ext") == ".js") & (i % 3 == 0), ".min.js")
           .when(i % 13 == 0, ".html").otherwise(F.col("ext")))
    return f.select(F.concat_ws("/", folder, "source", padded_name(i, ext)).alias("path"), "n_bytes")


def _discover(spark, sf, mode):
    cfg = CorpusConfig(exclude_mode=mode)
    return (code_tree(spark, sf).where(file_filter("path", "n_bytes", cfg))
            .select("path", suffix("path").alias("ext"), "n_bytes"))


def q_discover_filtered(spark, sf):
    return _discover(spark, sf, "substring")


def q_discover_glob(spark, sf):
    return _discover(spark, sf, "glob")


def q_ext_histogram(spark, sf):
    return C.ext_histogram(discovered(spark, sf))


def q_corpus_totals(spark, sf):
    return C.corpus_totals(discovered(spark, sf))


def q_strip_nonempty(spark, sf):
    t = load(spark, sf, "conversations")
    return (C.strip_nonempty(t.select("conv_id", "turn", "text"))
            .select("conv_id", "turn", "text",
                    F.length("text").alias("n_chars")))


def q_compose_pairs(spark, sf):
    return C.composed_pairs(load(spark, sf, "conversations"))


def q_file_names(spark, sf):
    f = code_files(spark, sf)
    return f.select(
        "doc_id",
        F.concat_ws("/", "source", "lang", padded_name(F.col("doc_id"), F.col("ext")))
        .alias("file_name"))


def _docs_stripped(spark, sf):
    f = code_files(spark, sf)
    return C.strip_nonempty(f.select("doc_id", "source", "text")).select(
        "doc_id", "source", F.octet_length("text").cast("long").alias("n_bytes"))


def q_quota_files(spark, sf):
    # each source is one dataset; source index = doc_id
    d = _docs_stripped(spark, sf)
    return C.take_until(d, ["doc_id"], "n_bytes", max_files=30, max_bytes=None,
                        group=["source"])


def q_quota_bytes(spark, sf):
    d = _docs_stripped(spark, sf)
    return C.take_until(d, ["doc_id"], "n_bytes", max_files=None, max_bytes=60000,
                        group=["source"])


def q_union_sources(spark, sf):
    docs = load(spark, sf, "documents").select(
        F.col("doc_id").alias("idx"), F.col("text").alias("content"))
    bench = load(spark, sf, "benchmark").select(
        F.col("item_id").alias("idx"), F.col("text").alias("content"))
    pages = load(spark, sf, "pages").select(
        F.col("page_id").alias("idx"), F.col("html").alias("content"))
    u = union_sources({"documents": docs, "benchmark": bench, "pages": pages})
    u = C.strip_nonempty(u, "content").select(
        "dataset", "idx", F.octet_length("content").cast("long").alias("n_bytes"))
    return C.take_until(u, ["idx"], "n_bytes", max_files=400, max_bytes=2_000_000,
                        group=["dataset"])


def q_tag_lookup(spark, sf):
    files = code_files(spark, sf).select("doc_id", "ext")
    return C.tag_ids(files, C.specials_df(spark)).select("doc_id", "ext", "tag", "tag_id")


def q_resolved_ids(spark, sf):
    """An id given for every other file, else its tag's, else a default."""
    given = F.when(F.col("doc_id") % 2 == 0, F.col("doc_id") % 3)
    tags = C.tag_ids(code_files(spark, sf).select("doc_id", "ext"), C.specials_df(spark))
    return tags.select("doc_id", C.resolve_id(given, F.col("tag_id"), 7).alias("id"))


def q_missing_specials(spark, sf):
    """Specials and benchmark words that a vocabulary of the corpus's
    words and the core specials lacks."""
    vocab = (word_histogram(load(spark, sf, "documents"), "text")
             .select(F.ltrim("word").alias("token"))
             .unionByName(spark.createDataFrame([(t,) for t in CORE_SPECIALS], "token string")))
    words = load(spark, sf, "benchmark").select(
        F.explode(F.regexp_extract_all("text", F.lit(HASH_WORD_RE), F.lit(0))).alias("token"))
    wanted = spark.createDataFrame([(t,) for t in SPECIALS], "token string").unionByName(words)
    return C.missing_tokens(wanted.distinct(), vocab)


def q_doc_index(spark, sf):
    """W1 + O1: dense 0-based index of every discovered file in path order."""
    f = discovered(spark, sf).select("doc_id", "path", path_parts("path").alias("_k"))
    return C.row_index(f, ["_k"]).select("doc_id", "idx")


QUERIES = {
    "discover_filtered": q_discover_filtered,
    "discover_glob": q_discover_glob,
    "ext_histogram": q_ext_histogram,
    "corpus_totals": q_corpus_totals,
    "strip_nonempty": q_strip_nonempty,
    "compose_pairs": q_compose_pairs,
    "file_names": q_file_names,
    "doc_index": q_doc_index,
    "quota_files": q_quota_files,
    "quota_bytes": q_quota_bytes,
    "union_sources": q_union_sources,
    "tag_lookup": q_tag_lookup,
    "resolved_ids": q_resolved_ids,
    "missing_specials": q_missing_specials,
}
