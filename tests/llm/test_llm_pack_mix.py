"""Packing, mixing, the pipeline and the guard of the entry module."""

import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
from conftest import SF_SMALL, table
from tokenizers import Tokenizer

from tokloom.llm import mixing, packing
from tokloom.llm.queries import ORACLE, QUERIES


def best_fit_brute(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        room = min((b for b in bins if b >= n), default=None)
        if room is not None:
            bins.remove(room)
        bins.append((capacity if room is None else room) - n)
    return len(bins)


def test_grouped_best_fit_is_best_fit():
    rng = random.Random(4)
    for capacity in (7, 16, 64):
        for _ in range(150):
            lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 150))]
            moves, n = packing.best_fit_moves(Counter(lengths), capacity)
            assert n == best_fit_brute(lengths, capacity)


def test_capacity_tree_finds_the_tightest():
    rng, open_ = random.Random(1), set()
    tree = packing.CapacityTree(20)
    for _ in range(500):
        r = rng.randint(0, 20)
        (open_.discard if r in open_ else open_.add)(r)
        tree.put(r, r in open_)
        need = rng.randint(1, 20)
        assert tree.tightest(need) == min((x for x in open_ if x >= need), default=None)


def hf():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [2]


def check_packing(rows, texts, capacity=1024):
    """Pieces rebuild the ids; sequences are gapless and as few as best fit."""
    encode, by_doc, by_seq = hf(), defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    lengths = []
    for d, parts in by_doc.items():
        ids, at = encode(texts[d]), 0
        for k, r in enumerate(sorted(parts, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == capacity or len(parts) == 1)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
            lengths.append(r.length)
        assert at == len(ids) and (len(parts) == 1 or len(ids) > capacity)
    for parts in by_seq.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
    assert len(by_seq) == best_fit_brute(lengths, capacity)


def test_packing_rebuilds_the_table(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    check_packing(packing.op3_packing(spark, SF_SMALL).collect(), texts)


def test_packing_odd_rows(spark, odd, none):
    rows = [(d, t, "s") for d, t in [(1, None), (2, ""), (3, "<|endoftext|> x"), (4, " " * 5000 + "a"),
                                     (5, "a" * 30_000), (6, "é\u0301\U0001f600 x" * 900), (7, "one " * 1023)]]
    check_packing(packing.pack(table(spark, rows)).collect(), {d: t for d, t, _ in rows})
    got = packing.pack(odd).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert Counter(r.doc_id for r in got if r.piece == 0) == Counter(r.doc_id for r in odd.collect())
    assert packing.pack(none).count() == 0


def test_registered_packing_takes_added_tokens_like_the_library(spark, tmp_path):
    texts = ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|><|endoftext|> y\n", "<|endoftext|", "plain"]
    want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    table(spark, [(i, t, "s") for i, t in enumerate(texts)]).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for got in (packing.op3_packing(spark, str(tmp_path)), corpus_pipeline.packing(spark, docs, str(tmp_path))):
        rows = {r.doc_id: (r.length, r.ids_crc32) for r in got.collect()}
        for i, t in enumerate(texts):
            ids = want.encode(t, add_special_tokens=False).ids + [2]
            assert rows[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    blanks = "end <|endoftext|>" + " " * 5000 + "a<|endoftext|>"
    assert packing.encoder(added_tokens=True)(blanks).tolist() == want.encode(blanks, add_special_tokens=False).ids


def targets_brute(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    free, left, out = set(order), share * sum(sizes.values()), {}
    while free:
        level = left / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > cap * sizes[s]]
        if not over:
            return {**out, **{s: level * w[s] for s in free}}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


def test_targets_are_the_repeated_sharing(spark):
    rng = random.Random(6)
    for n in (1, 2, 3, 7, 12):
        sizes = {f"s{i}": rng.choice([0, 1, 10, 100, 10_000]) for i in range(n)}
        if n > 2:
            sizes[None] = 50
        rows = [(s, x) for s, k in sizes.items() for x in (k // 2, k - k // 2)]
        got = {r.source: r.target for r in mixing.source_rates(
            spark.createDataFrame(rows, "source string, size long")).collect()}
        want = targets_brute(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - want[s]) <= 1e-9 * max(1, want[s]) for s in want)


def test_mix_takes_near_targets_and_reruns_agree(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["a", "b", "c", "d", None]))
            for i in range(3000)]
    df = table(spark, rows)
    got = mixing.mix_plan(df).collect()
    assert len(got) == 3000 and all(r.taken <= 2 * r.size and r.taken % max(r.size, 1) == 0 for r in got)
    source = {d: s for d, _, s in rows}
    taken, target = Counter(), {}
    for r in got:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - t) < 0.1 * t for s, t in target.items())
    again = mixing.mix_plan(df.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    out = mixing.emit_mix(df)
    assert out.columns == df.columns
    copies = Counter(r.doc_id for r in out.select("doc_id").collect())
    assert copies == Counter({r.doc_id: r.n_copies for r in got if r.n_copies})


def test_mix_odd_rows(odd, none):
    got = mixing.mix_plan(odd).collect()
    assert len(got) == odd.count() and all(r.size == 0 for r in got if r.doc_id in (1, 2, 3))
    assert mixing.mix_plan(none).count() == 0 and mixing.emit_mix(none).count() == 0
    assert mixing.emit_mix(odd).columns == odd.columns


def test_pipeline_stages_keep_their_contract(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, ids = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        if name == "packing":
            break
        assert out.columns == columns and out.schema == docs.schema
        rows = out.collect()
        if name in ("toxicity", "ngram_join"):
            assert len({r.doc_id for r in rows}) == len(rows) <= docs.count()
        if name == "line_dedup":
            assert {r.doc_id for r in rows} == ids and all(r.n_chars == len(r.text) for r in rows)
        ids = {r.doc_id for r in rows}
        docs = spark.createDataFrame(rows, docs.schema)
    assert {r.doc_id for r in out.collect()} == ids
    packed = corpus_pipeline.run(spark, SF_SMALL)
    assert {r.doc_id for r in packed.collect()} == ids


def test_queries_are_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(ORACLE) <= set(QUERIES) and set(ORACLE) <= set(entry.oracle_sql())
