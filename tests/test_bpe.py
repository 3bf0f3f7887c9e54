import json

import pytest

from tokloom.config import SPECIALS, VOCAB_SIZE
from tokloom.operators.bpe import (BpeModel, base_model, learn_vocab, train_bpe,
                                   word_histogram)
from tokloom.operators.encode import decode_ids, encode_docs, merge_word

tokenizers = pytest.importorskip("tokenizers")


def library_bpe(texts, vocab_size):
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers
    tok = Tokenizer(models.BPE(unk_token="<unk>"))
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    tr = trainers.BpeTrainer(vocab_size=vocab_size, min_frequency=2, special_tokens=list(SPECIALS),
                             initial_alphabet=pre_tokenizers.ByteLevel.alphabet(),
                             show_progress=False)
    tok.train_from_iterator(texts, tr)
    m = json.loads(tok.to_str())["model"]
    merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in m["merges"]]
    return tok, merges, m["vocab"]


def ours(model: BpeModel):
    return [(model.tokens[a], model.tokens[b]) for a, b, _ in model.merges]


def test_tiny_corpus_matches_library(spark):
    texts = ["low " * 5 + "lower " * 2 + "newest " * 6 + "widest " * 3 + "aaaa aaaa"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model = learn_vocab(df, 15 + 256 + 40)
    _, lib, vocab = library_bpe(texts, 15 + 256 + 40)
    assert ours(model) == lib
    assert all(vocab[t] == i for i, t in enumerate(model.tokens))


def test_collision_merge_reuses_id(spark):
    # "the" is reached by two merge paths; the vocabulary must not grow twice
    words = ["the"] * 8 + ["th"] * 6 + ["he"] * 7 + ["t he"] * 5 + ["x the"] * 4
    texts = [" ".join(words)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model = learn_vocab(df, 15 + 256 + 12)
    _, lib, vocab = library_bpe(texts, 15 + 256 + 12)
    assert ours(model) == lib
    assert all(vocab[t] == i for i, t in enumerate(model.tokens))


def test_real_documents_match_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet") \
        .orderBy("doc_id").limit(40).select("text")
    texts = [r.text.strip() for r in docs.collect()]
    model = learn_vocab(docs, 15 + 256 + 120)
    _, lib, _ = library_bpe(texts, 15 + 256 + 120)
    assert ours(model) == lib


def test_encode_matches_library_and_round_trips(spark):
    corpus = ["class Queue:\n    size = 3\n\n    def push(self, item): ...\n"] * 3 + \
             ["x = 1\n\ty = 'é ✓ 😀'\r\n", "tabs\tand  spaces   end"]
    df = spark.createDataFrame([(t,) for t in corpus], "text string")
    model = learn_vocab(df, 15 + 256 + 60)
    tok, _, _ = library_bpe([c.strip() for c in corpus], 15 + 256 + 60)
    tests = ["class Queue:\n    size = 4  # push", "a\x00b\nc", "ünïcödé 😀"]
    docs = spark.createDataFrame(list(enumerate(tests)), "doc_id long, text string")
    enc = {r.doc_id: r.ids for r in encode_docs(docs, model, strip=False).collect()}
    for i, t in enumerate(tests):
        assert enc[i] == tok.encode(t).ids, t
    dec = {r.doc_id: r.text for r in decode_ids(encode_docs(docs, model, strip=False),
                                                 model.vocab_df(spark)).collect()}
    assert dec == dict(enumerate(tests))
    # newline has its own byte symbol: never <unk>
    assert 0 not in enc[1]


def test_merge_word_heap_order():
    # ranks: (1,2)->10 rank0, (10,1)->11 rank1, (2,1)->12 rank2
    ranks = {(1, 2): (0, 10), (10, 1): (1, 11), (2, 1): (2, 12)}
    assert merge_word([1, 2, 1, 2], ranks) == [10, 10]
    assert merge_word([1, 2, 1], ranks) == [11]
    assert merge_word([2, 1], ranks) == [12]
    assert merge_word([5], ranks) == [5]


def test_word_histogram_counts(spark):
    df = spark.createDataFrame([("ab ab  cd's",)], "text string")
    got = {r.word: r.n for r in word_histogram(df).collect()}
    assert got == {"ab": 1, " ab": 1, " ": 1, " cd": 1, "'s": 1}


BLANKS = ["x \xa0b", "\xa0!", "a\u3000\u3000b", "l\u0085m \u0085", "\u2003w\u2003 v", "tab\t\xa0x  ", "\u202f1 \u20282"]


def test_unicode_blanks_split_like_the_library(spark):
    from tokenizers import pre_tokenizers
    from tokloom.functions.bytelevel import CHAR_TO_BYTE
    from tokloom.operators.bpe import pretokenize
    lib = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    df = spark.createDataFrame(list(enumerate(BLANKS)), "i int, t string")
    for r in df.select("i", pretokenize("t").alias("w")).collect():
        want = [bytes(CHAR_TO_BYTE[c] for c in w).decode() for w, _ in lib.pre_tokenize_str(BLANKS[r.i])]
        assert r.w == want, BLANKS[r.i]


def test_tokenizer_tables_round_trip(spark, tmp_path):
    from tokloom.sources.sinks import read_tokenizer, write_tokenizer
    df = spark.createDataFrame([("the theme then there",)] * 3, "text string")
    model = learn_vocab(df, 15 + 256 + 8)
    write_tokenizer(model.vocab_df(spark), model.merges_df(spark), str(tmp_path / "tok"))
    back = read_tokenizer(spark, str(tmp_path / "tok"))
    assert (back.tokens, back.merges, back.n_special) == (model.tokens, model.merges, model.n_special)


def test_encode_and_decode_shuffle_nothing(spark):
    df = spark.createDataFrame([(1, "the theme"), (2, "then")], "doc_id long, text string")
    model = learn_vocab(df, 15 + 256 + 4, min_freq=1)
    plan = decode_ids(encode_docs(df, model), model.vocab_df(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 2


def test_a_thousand_merges_match_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet") \
        .orderBy("doc_id").limit(25).select("text")
    texts = [r.text.strip() for r in docs.collect()]
    model = learn_vocab(docs, 15 + 256 + 1000)
    _, lib, _ = library_bpe(texts, 15 + 256 + 1000)
    assert len(lib) == 1000 and ours(model) == lib


def test_min_freq_stops(spark):
    df = spark.createDataFrame([("ab cd",)], "text string")
    model = train_bpe(word_histogram(df), 15 + 256 + 10)
    assert model.merges == []
    assert len(base_model().tokens) == 271


@pytest.mark.parametrize("candidates,ahead", [(4000, 0), (4000, 1500), (20, 1_000_000), (4000, 1_000_000)])
def test_ways_to_decide_merges_agree(spark, candidates, ahead):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet") \
        .orderBy("doc_id").limit(30).select("text")
    hist = word_histogram(docs)
    model = train_bpe(hist, 15 + 256 + 150, candidates=candidates, ahead_symbols=ahead)
    texts = [r.text.strip() for r in docs.collect()]
    _, lib, _ = library_bpe(texts, 15 + 256 + 150)
    assert ours(model) == lib


def test_few_rounds_when_the_words_are_too_many_for_the_driver(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    model = learn_vocab(docs, 15 + 256 + 1500, ahead_symbols=20_000)
    texts = [r.text.strip() for r in docs.collect() if r.text and r.text.strip()]
    _, lib, _ = library_bpe(texts, 15 + 256 + 1500)
    assert ours(model) == lib
    assert model.rounds <= 40


def test_full_vocabulary_matches_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    texts = [r.text.strip() for r in docs.collect() if r.text and r.text.strip()]
    model = learn_vocab(docs)
    _, lib, vocab = library_bpe(texts, VOCAB_SIZE)
    assert len(lib) >= 5000 and ours(model) == lib
    assert all(vocab[t] == i for i, t in enumerate(model.tokens))
    assert model.rounds < 100


def test_pieces_have_the_words_of_the_text(spark):
    import random

    from pyspark.sql import functions as F
    from tokloom.operators.bpe import pretokenize, text_pieces
    rng = random.Random(9)
    parts = ["a", "bc", "7", "42", " ", "  ", "\n", "\t ", "'s", "'", "'ll", "é", "漢", "!?", "_", "\u3000", "\xa0", "😀", "\u0301"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 200))) for _ in range(300)]
    texts += ["x" * 500, " " * 500, "'s" * 200, "it's " * 100, "a1" * 200, "a 'll" * 90, "1 's" * 80]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for chars in (1, 7, 40):
        got = df.select("i", "t", pretokenize("t").alias("w"), text_pieces("t", chars).alias("p"),
                        F.flatten(F.transform(text_pieces("t", chars), pretokenize)).alias("pw")).collect()
        for r in got:
            assert "".join(r.p) == r.t and r.pw == r.w, (chars, r.t)
        assert all(len(r.p) > 2 for r in got if len(r.t) > 150 and r.i < 300)
    hist = {r.word: r.n for r in word_histogram(df, "t", piece_chars=7).collect()}
    assert hist == {r.word: r.n for r in word_histogram(df, "t").collect()}


def test_encoded_pieces_make_the_document(spark):
    from tokloom.operators.encode import encode_pieces
    text = "it's the theme, then 12 there! " * 50
    df = spark.createDataFrame([(1, text), (2, "then"), (3, "")], "doc_id long, text string")
    model = learn_vocab(df, 15 + 256 + 20)
    whole = {r.doc_id: r.ids for r in encode_docs(df, model).collect()}
    rows = encode_pieces(df, model, piece_chars=64).collect()
    assert sum(r.doc_id == 1 for r in rows) > 10 and max(len(r.ids) for r in rows) < 100
    for d in (1, 2):
        assert [x for r in sorted(rows, key=lambda r: r.piece) if r.doc_id == d for x in r.ids] == whole[d]
