"""Catalogue queries over the token stream (W3, T4-T9, T3*).

The oracle-checked stream queries use the word-hash tokenizer so an SQL
engine can follow every id; the BPE queries run the learned vocabulary.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tokloom.config import (EOT_ID, TRAIN_SHUFFLE_SEED, VAL_RATIO,
                            special_id)
from tokloom.functions.text import path_parts, py_strip, storage_dtype
from tokloom.operators import corpus as C
from tokloom.operators import stream as S
from tokloom.operators.encode import assemble, new_tokens
from tokloom.operators.fim import collate, fim_prompt, fim_samples
from tokloom.plans.corpus_queries import discovered
from tokloom.sources.tables import load

PACK_BLOCK = 128
STRIDE_BLOCK = 16
FIM_BLOCK = 61          # FIM source window = max_len - 3 for max_len 64
BATCH = 8
FIM_SEED = 42


def doc_sequences(spark, sf):
    """Discovered files -> tag + word-hash ids + eot."""
    files = discovered(spark, sf).select("doc_id", "path", "ext", "text")
    toks = S.hash_tokenize(files)
    toks = C.tag_ids(toks, C.specials_df(spark))
    return toks.select("doc_id", "path", assemble(F.col("ids"), F.col("tag_id"), EOT_ID).alias("ids"))


def doc_stream(spark, sf):
    """The sequences with global offsets in path order."""
    return S.stream_offsets(doc_sequences(spark, sf).withColumn("_k", path_parts("path")),
                            ["_k"]).drop("_k")


def split_stream(spark, sf, split):
    """(stream of one split, its number of tokens)."""
    st = doc_stream(spark, sf)
    n_train, n_val, _ = S.split_sizes(S.total_tokens(st), VAL_RATIO)
    part = S.split_tail(st, n_train + n_val, VAL_RATIO).where(F.col("split") == split)
    return part, n_train if split == "train" else n_val


def q_stream_offsets(spark, sf):
    return doc_stream(spark, sf).select(
        "doc_id", "start_off", F.size("ids").cast("long").alias("n_tokens"))


def q_split_tail(spark, sf):
    st = doc_stream(spark, sf)
    total = S.total_tokens(st)
    sp = S.split_tail(st, total, VAL_RATIO)
    return sp.select("split", "doc_id", "start_off",
                     F.size("ids").cast("long").alias("n_tokens"), "ids")


def q_split_hash(spark, sf):
    return (S.split_hash(doc_sequences(spark, sf), 0.1, FIM_SEED)
            .groupBy("split").agg(F.count(F.lit(1)).alias("n_docs"),
                                  F.sum(F.size("ids")).cast("long").alias("n_tokens")))


def q_meta_row(spark, sf):
    """The metadata row of a word-hash corpus (one aggregate
    chain: per-extension partials, then the row)."""
    files = discovered(spark, sf)
    total = S.total_tokens(doc_sequences(spark, sf))
    n_train, n_val, r = S.split_sizes(total, VAL_RATIO)
    vocab_size = 30100
    skipped = F.length(py_strip("text")) == 0
    per_ext = files.groupBy("ext").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum(F.when(skipped, 1).otherwise(0)).alias("n_skip"))
    return per_ext.agg(
        F.sum("n_files").cast("long").alias("total_files"),
        F.sum("n_skip").cast("long").alias("skipped_files"),
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("ext", F.col("n_files").cast("long").alias("n_files")))),
            lambda e: F.concat(e["ext"], F.lit("="), e["n_files"].cast("string"))), ",")
        .alias("ext_counts"),
    ).select(
        F.lit(vocab_size).cast("long").alias("vocab_size"),
        F.lit(total).cast("long").alias("total_tokens"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        F.lit(n_val).cast("long").alias("val_tokens"),
        F.lit(r).alias("val_ratio"),
        storage_dtype(F.lit(vocab_size)).alias("dtype"),
        "total_files", "skipped_files", "ext_counts")


def q_new_tokens(spark, sf):
    """What follows the prompt, the first half of each sequence here."""
    half = F.floor(F.size("ids") / 2).cast("int")
    return doc_sequences(spark, sf).select("doc_id", new_tokens(F.col("ids"), half).alias("ids"))


def _blocks(spark, sf, b):
    return S.blocks(doc_stream(spark, sf), b, ahead=1)


def q_windows_packed(spark, sf):
    return S.windows_packed(_blocks(spark, sf, PACK_BLOCK), PACK_BLOCK)


def q_windows_stride(spark, sf):
    """Stride 1: every start's window."""
    st = doc_stream(spark, sf)
    return S.windows_strided(S.blocks(st, STRIDE_BLOCK), STRIDE_BLOCK, 1, S.total_tokens(st))


def _windows(spark, sf, split):
    """(windows of one split, how many)."""
    part, n = split_stream(spark, sf, split)
    return (S.windows_packed(S.blocks(part, FIM_BLOCK, ahead=1), FIM_BLOCK),
            S.window_count(n, FIM_BLOCK, FIM_BLOCK))


def q_train_batches(spark, sf):
    w, n = _windows(spark, sf, "train")
    return S.shuffled_batches(w.select("win_id"), BATCH, TRAIN_SHUFFLE_SEED, n)


def q_train_epochs(spark, sf):
    """U3 + O5 + T8: two passes over the training windows, each epoch in
    its own shuffled order with its own batches."""
    w, n = _windows(spark, sf, "train")
    return S.shuffled_batches(S.epochs(w.select("win_id"), 2), BATCH, TRAIN_SHUFFLE_SEED, n,
                              epoch="epoch").select("epoch", "win_id", "batch_id", "row")


def q_val_batches(spark, sf):
    w, _ = _windows(spark, sf, "val")
    b = S.sequential_batches(w, BATCH)
    return b.select("batch_id", "row", "win_id", "x", "y")


def fim(windows):
    return fim_samples(windows, FIM_SEED, special_id("<fim_prefix>"), special_id("<fim_suffix>"),
                       special_id("<fim_middle>"), special_id("<eos>"))


def q_fim_samples(spark, sf):
    w, _ = _windows(spark, sf, "train")
    return fim(w.select("win_id", "x")).select("win_id", "input_ids", "labels")


def q_collated_batches(spark, sf):
    """Training as it is fed: shuffled batches, FIM per sample, padding."""
    w, n = _windows(spark, sf, "train")
    b = S.shuffled_batches(w.select("win_id", "x"), BATCH, TRAIN_SHUFFLE_SEED, n)
    f = fim(b).select("batch_id", "row", "win_id", "input_ids", "labels")
    return collate(f, special_id("<pad>")).select(
        "batch_id", "row", "win_id", "input_ids", "labels", "attention_mask")


def q_fim_prompt(spark, sf):
    b = load(spark, sf, "benchmark")
    half = F.floor(F.length("text") / 2).cast("int")
    pre = F.substring("text", F.lit(1), half)
    suf = F.expr("substring(text, floor(length(text) / 2) + 1)")
    return b.select("item_id", fim_prompt(pre, suf).alias("prompt"))


QUERIES = {
    "stream_offsets": q_stream_offsets,
    "split_tail": q_split_tail,
    "split_hash": q_split_hash,
    "meta_row": q_meta_row,
    "new_tokens": q_new_tokens,
    "windows_packed": q_windows_packed,
    "windows_stride": q_windows_stride,
    "train_batches": q_train_batches,
    "train_epochs": q_train_epochs,
    "val_batches": q_val_batches,
    "fim_samples": q_fim_samples,
    "collated_batches": q_collated_batches,
    "fim_prompt": q_fim_prompt,
}
