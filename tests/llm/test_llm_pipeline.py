"""The pipeline against its stages' brute-force versions, and on odd tables."""

from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from conftest import SF_SMALL
from test_llm_dedup import join_brute, words_brute
from tokenizers import Tokenizer

from tokloom.llm import mixing, toxicity


def test_pipeline_is_its_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").select("doc_id", "toxic")
    score = toxicity.train_side(docs, labels).scorer()
    clean = [(r.doc_id, r.text) for r in docs.collect() if score(r.text or "") < 0.5]
    cut = [(d, t) for d, (t, _) in words_brute(clean).items()]
    kept = {d for d, n, c in join_brute(cut, 5, 80) if n == 0 or c == d}
    source = {r.doc_id: r.source for r in docs.collect()}
    left = spark.createDataFrame([(d, t, source[d]) for d, t in cut if d in kept], "doc_id long, text string, source string")
    copies = {r.doc_id: r.n_copies for r in mixing.mix_plan(left).collect()}
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    want = Counter()
    for d, t in cut:
        if d in kept:
            n = len(encode(t, add_special_tokens=False).ids) + 1
            first = n % 1024 or min(n, 1024)
            edges = [0, *range(first, n + 1, 1024)]
            for k, (a, b) in enumerate(zip(edges, edges[1:])):
                want[d, k, a, b - a] += copies[d]
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in rows) == +want
    filled = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id]
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 1024


@pytest.mark.parametrize("kind", ["odd", "none"])
def test_stages_take_odd_tables(spark, odd, none, kind):
    docs = {"odd": odd, "none": none}[kind]
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        if name == "packing":
            assert out.count() >= docs.count() and (n or out.count() == 0)
            break
        assert out.columns == docs.columns and out.schema == docs.schema
        rows = out.collect()
        if name in ("toxicity", "line_dedup"):
            assert len(rows) == n
        if name == "line_dedup" and n:
            texts = {r.doc_id: r.text for r in rows if r.doc_id is not None}
            assert texts[1] is None and texts[2] == "" and texts[4] == "one" and texts[7] == ""
            assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
        if name == "ngram_join" and n:  # one of the equal texts stays; rows without words all do
            assert sorted(r.doc_id for r in rows if r.text == "one") == [4]
            assert {1, 2, 3, 7} <= {r.doc_id for r in rows} and any(r.doc_id is None for r in rows)
        docs = spark.createDataFrame(rows, docs.schema)
