"""Words, places and samples made a batch at a time equal those made one by one."""

import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tokloom.functions.bytelevel import byte_ids
from tokloom.functions.text import py_strip
from tokloom.operators import stream as S
from tokloom.operators.bpe import learn_vocab, pretokenize, word_histogram
from tokloom.operators.encode import _ranks, encode_docs, merge_word
from tokloom.operators.fim import fim_samples

PARTS = ["a", "bc", "s", "7", "42", " ", " ", "  ", "\n", "\t ", "'s", "'", "'ll", "'r", "e", "'ve", "'d", "é", "漢", "!?", "_",
         "　", "\xa0", "😀", "́", "\u0085", "\x1c", "𝟘", "𐐀", "½", "​", " ", "<unk>"]


def odd_texts(n=800):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return texts + [None, "", " ", "'", "'s", "s", "　", "a　", "　a", "'é", "'sé", "it's " * 300, "x" * 900, " " * 900]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_words_are_those_of_the_expression(spark):
    df = spark.createDataFrame(list(enumerate(odd_texts())), "doc_id long, text string").repartition(3)
    for strip in (True, False):
        t = py_strip("text") if strip else F.col("text")
        want = {r.word: r.n for r in df.select(F.explode(pretokenize(t)).alias("word")).groupBy("word")
                .agg(F.count(F.lit(1)).alias("n")).collect()}
        got = word_histogram(df, strip=strip, piece_chars=50)
        assert {r.word: r.n for r in got.collect()} == want
    # the expression matched word by word (F2, F4: 92 of 292 s on 0.5 GB)
    assert "regexp_extract_all" not in plan(got) and "MapInArrow" in plan(got)


def test_bad_bytes_are_read_as_the_jvm_reads_them(spark):
    df = spark.sql("SELECT CAST(X'6162FF20C3' AS STRING) AS text")
    want = [r.w for r in df.select(F.explode(pretokenize("text")).alias("w")).collect()]
    assert sorted(r.word for r in word_histogram(df).collect()) == sorted(want) and len(want) == 3


def test_ids_are_those_of_merging_word_by_word(spark):
    df = spark.createDataFrame(list(enumerate(odd_texts())), "doc_id long, text string").repartition(3)
    model = learn_vocab(df, 15 + 256 + 60)
    table, ranks = byte_ids(model.n_special), _ranks(model)
    for strip in (True, False):
        t = py_strip("text") if strip else F.col("text")
        words = df.select("doc_id", t.alias("t")).where(F.length("t") > 0).select("doc_id", pretokenize("t").alias("w")).collect()
        want = {r.doc_id: [i for w in r.w for i in merge_word([table[b] for b in w.encode()], ranks)] for r in words}
        enc = encode_docs(df, model, strip=strip)
        assert {r.doc_id: r.ids for r in enc.collect()} == want
    assert "regexp_extract_all" not in plan(enc)


def test_long_texts_are_encoded_in_parts(spark):
    from tokloom.operators.words import char_classes, slices, words_of
    text = pa.array(["it's 12 theme　 then! " * 40, None, "ab", "x" * 300])
    classes = char_classes(spark)
    whole = [w for *_, b, _, e in slices(text, True) for _, ws in words_of(b, e, classes) for w in ws.to_pylist()]
    for most in (1, 30, 200):
        parts = [len(b) for *_, b, _, e in slices(text, True, most, most) for _, ws in words_of(b, e, classes, most)]
        cut = [w for *_, b, _, e in slices(text, True, most, most) for _, ws in words_of(b, e, classes, most) for w in ws.to_pylist()]
        assert cut == whole and len(parts) > 3


def test_a_place_hashes_rows_and_columns_only(spark):
    n = 5000

    def h(*parts):
        return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16)

    a = 71
    b = -(-n // a)

    def move(cell, *key):
        col, row = divmod(cell, b)
        for r in range(S.ROUNDS):
            if r % 2 == 0:
                col = (col + h(*key, r, row)) % a
            else:
                row = (row + h(*key, r, col)) % b
        return col * b + row

    def place(x, *key):
        x = move(x, *key)
        while x >= n:
            x = move(x, *key)
        return x

    df = spark.range(n).select("id", (F.col("id") % 3).alias("e"))
    got = df.select("id", "e", S.permuted(F.col("id"), n, 7).alias("p"), S.permuted(F.col("id"), n, 7, F.col("e")).alias("q")).collect()
    assert all(r.p == place(r.id, 7) and r.q == place(r.id, 7, r.e) for r in got)
    known: dict = {}
    assert len(set(S._hashes("7|", 0, np.arange(n) % 10, known))) == 10 and len(known["7|", 0]) == 10
    out = S.shuffled_batches(spark.range(n).withColumnRenamed("id", "win_id"), 8, 7, n)
    assert "md5" not in plan(out) and plan(out).count("ArrowEvalPython") == 1  # was hashed anew for each use (F1, F3)


def test_a_sample_is_hashed_four_times_at_most(spark):
    df = spark.createDataFrame([*((i, list(range(20, 21 + i % 40))) for i in range(200)), (None, list(range(30))), (7, None)],
                               "win_id long, x array<int>")
    out = fim_samples(df, 42, 4, 5, 6, 3)
    assert plan(out).count("md5") <= 4
    from tokloom.functions.hashing import uniform
    from tokloom.operators.fim import fim_ids
    k = F.col("win_id")
    s = F.when(uniform(42, k, 0) < 0.5, fim_ids(F.col("x"), k, 42, 4, 5, 6, 3)).otherwise(F.col("x"))
    want = df.select("win_id", s.alias("s")).collect()
    got = {r.win_id: r for r in out.collect() if r.x is not None}
    assert out.columns == ["win_id", "x", "input_ids", "labels"]
    assert all(got[r.win_id].input_ids == r.s[:-1] and got[r.win_id].labels == r.s[1:]
               for r in want if r.s is not None and r.win_id != 7 and len(r.s) > 1)


def test_batches_are_dealt_once(spark, monkeypatch):
    """the samples' one exchange moves them before FIM doubles them."""
    from tokloom.plans import token_queries as Q
    w = spark.range(400).select(F.col("id").alias("win_id"), F.transform(F.sequence(F.lit(1), F.lit(61)), lambda i: i + F.col("id").cast("int")).alias("x"))
    monkeypatch.setattr(Q, "_shard_windows", lambda *a: (w, 400))
    out = Q.q_train_samples(spark, None)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(batch_id") == 1 and text.count("Sort [batch_id") == 1
    assert text.index("Window") < text.index("Exchange hashpartitioning(batch_id")
    line = next(x for x in text.splitlines() if "Exchange hashpartitioning" in x)
    below = text[text.index(line):]
    assert "input_ids" not in below and "labels" not in below
    rows = out.collect()
    assert sorted(r.win_id for r in rows) == list(range(400)) and len({(r.batch_id, r.row) for r in rows}) == 400
