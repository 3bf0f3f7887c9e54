"""Catalogue queries over vocabulary learning and BPE (T1-T3b, A4, A5), and the
whole way from files to training batches on BPE ids (E1, E3)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from tokloom.config import (EOT_ID, MIN_FREQ, SPECIALS, TRAIN_SHUFFLE_SEED, VAL_RATIO, VOCAB_SIZE,
                            special_id)
from tokloom.functions.text import path_parts
from tokloom.operators import bpe as B
from tokloom.operators import corpus as C
from tokloom.operators import encode as EN
from tokloom.operators import positions as P
from tokloom.operators import stream as S
from tokloom.operators.fim import collate
from tokloom.plans.corpus_queries import discovered
from tokloom.plans.stream_queries import BATCH, FIM_BLOCK, doc_stream, fim
from tokloom.session import scratch
from tokloom.sources.ledger import run_stage
from tokloom.sources.sinks import read_tokenizer, write_tokenizer
from tokloom.sources.tables import load, read_shards

# The queries learn config.VOCAB_SIZE tokens.  Each has a second form, with the
# suffix _48, that learns so many merges: those the oracle can follow one by
# one as steps of SQL.
QUERY_MERGES = 48
SMALL = len(SPECIALS) + 256 + QUERY_MERGES
#: Ids of the word-hash tokenizer are below this.
HASH_VOCAB = 30_100


def q_word_histogram(spark, sf):
    return B.word_histogram(load(spark, sf, "documents"), "text")


def q_pair_counts(spark, sf):
    return B.byte_pair_counts(B.word_histogram(load(spark, sf, "documents"), "text"))


def q_alphabet(spark, sf):
    return B.byte_histogram(B.word_histogram(load(spark, sf, "documents"), "text"))


def learned_model(spark, sf, vocab_size=VOCAB_SIZE):
    """Model learned from the corpus, stored as K4 tables and read back; the
    stage ledger finds one that was learned from the same rows before."""
    docs = load(spark, sf, "documents").select("text")

    def learn(path):
        model = B.learn_vocab(docs, vocab_size)
        write_tokenizer(model.vocab_df(spark), model.merges_df(spark), path)

    return read_tokenizer(spark, run_stage(
        spark, "tokenizer", [docs], {"vocab_size": vocab_size, "min_freq": MIN_FREQ}, learn))


def q_bpe_merges(spark, sf, vocab_size=VOCAB_SIZE):
    return learned_model(spark, sf, vocab_size).merges_df(spark)


def q_bpe_encode(spark, sf, vocab_size=VOCAB_SIZE):
    m = learned_model(spark, sf, vocab_size)
    enc = EN.encode_docs(load(spark, sf, "documents").select("doc_id", "text"), m)
    return enc.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


def q_bpe_roundtrip(spark, sf, vocab_size=VOCAB_SIZE):
    """decode(encode(text)) for every document; equals the stripped text."""
    m = learned_model(spark, sf, vocab_size)
    enc = EN.encode_docs(load(spark, sf, "documents").select("doc_id", "text"), m)
    return EN.decode_ids(enc, m.vocab_df(spark)).select("doc_id", "text")


def q_prompt_encode(spark, sf, vocab_size=VOCAB_SIZE):
    """T3c + P16: benchmark prompts as <bos> ids <eos> with the learned
    vocabulary (a blank prompt would be the single id <bos>)."""
    m = learned_model(spark, sf, vocab_size)
    b = load(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    enc = EN.encode_docs(b, m)
    j = b.join(enc, "doc_id", "left")
    ids = F.coalesce(F.col("ids"), F.array().cast("array<int>"))
    return j.select(F.col("doc_id").alias("item_id"),
                    EN.prompt_ids(F.col("text"), ids, special_id("<bos>"), special_id("<eos>"))
                    .alias("ids"))


def bpe_stream(spark, sf, vocab_size=VOCAB_SIZE):
    """Discovered files -> BPE ids -> tag + ids + eot -> global offsets."""
    files = discovered(spark, sf).select("doc_id", "path", "ext", "text")
    enc = EN.encode_docs(files, learned_model(spark, sf, vocab_size), keep=("path", "ext"))
    seq = C.tag_ids(enc, C.specials_df(spark)).select(
        "doc_id", path_parts("path").alias("_k"),
        EN.assemble(F.col("ids"), F.col("tag_id"), EOT_ID).alias("ids"))
    return S.stream_offsets(seq, ["_k"]).drop("_k")


def _shards(spark, sf, vocab_size):
    """E1 to the end: both splits written as packed token shards; their folder."""
    st = bpe_stream(spark, sf, vocab_size)
    out = scratch(spark, "shards")
    P.write_packed_shards(S.split_tail(st, S.total_tokens(st), VAL_RATIO), out, vocab_size)
    return out


def _shard_split(spark, path, split, vocab_size):
    return read_shards(spark, path, split, FIM_BLOCK).withColumn(
        "ids", P.unpack_ids(F.col("ids"), P.id_bytes(vocab_size)))


def q_token_shards(spark, sf, vocab_size=VOCAB_SIZE):
    out = _shards(spark, sf, vocab_size)
    both = [_shard_split(spark, out, s, vocab_size) for s in ("train", "val")]
    return both[0].unionByName(both[1]).select(
        "split", "doc_id", "start_off", F.size("ids").cast("long").alias("n_tokens"), "ids")


def q_windows_at(spark, sf):
    """T4 by position: the window from each document's first token on, read
    from packed shards through their index."""
    out = scratch(spark, "shards")
    P.write_packed_shards(doc_stream(spark, sf).select(F.lit("all").alias("split"), "doc_id", "start_off", "ids"), out, HASH_VOCAB)
    starts = spark.read.parquet(out).select(F.col("start_off").alias("start"))
    return P.read_windows(spark, out, "all", starts, FIM_BLOCK, HASH_VOCAB)[0]


def _shard_windows(spark, sf, split, vocab_size):
    part = _shard_split(spark, _shards(spark, sf, vocab_size), split, vocab_size)
    n = S.window_count(S.total_tokens(part), FIM_BLOCK, FIM_BLOCK)
    return S.windows_packed(S.blocks(part, FIM_BLOCK, ahead=1), FIM_BLOCK), n


def q_train_samples(spark, sf, vocab_size=VOCAB_SIZE):
    """E3, train: shard windows, shuffled batches, FIM per sample, padding."""
    w, n = _shard_windows(spark, sf, "train", vocab_size)
    b = S.shuffled_batches(w.select("win_id", "x"), BATCH, TRAIN_SHUFFLE_SEED, n)
    # a batch's rows meet before they are doubled; collation deals them no more
    b = b.repartition("batch_id").sortWithinPartitions("batch_id")
    f = fim(b).select("batch_id", "row", "win_id", "input_ids", "labels")
    return collate(f, special_id("<pad>")).select(
        "batch_id", "row", "win_id", "input_ids", "labels", "attention_mask")


def q_val_samples(spark, sf, vocab_size=VOCAB_SIZE):
    """E3, validation: shard windows in order, as they are."""
    w, _ = _shard_windows(spark, sf, "val", vocab_size)
    return S.sequential_batches(w, BATCH).select("batch_id", "row", "win_id", "x", "y")


LEARNED = {
    "bpe_merges": q_bpe_merges,
    "bpe_encode": q_bpe_encode,
    "bpe_roundtrip": q_bpe_roundtrip,
    "prompt_encode": q_prompt_encode,
    "token_shards": q_token_shards,
    "train_samples": q_train_samples,
    "val_samples": q_val_samples,
}

QUERIES = {
    "word_histogram": q_word_histogram,
    "pair_counts": q_pair_counts,
    "alphabet": q_alphabet,
    "windows_at": q_windows_at,
    **LEARNED,
    **{f"{name}_{QUERY_MERGES}": partial(q, vocab_size=SMALL) for name, q in LEARNED.items()},
}
