"""Personal data, toxicity, chat formatting, fingerprints and LM scores."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import LONG, SF_SMALL
from pyspark.sql import functions as F

from tokloom.llm import chat, fingerprint, lm_score, pii, toxicity


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    """The contract, with the plain expressions and Python's matcher."""
    ok = {
        "email": lambda m: True,
        "ip": lambda m: all(int(x) <= 255 for x in m.split(".")),
        "card": lambda m: 16 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m)),
        "phone": lambda m: 8 <= len(re.sub(r"\D", "", m)) <= 15,
    }
    return [(k, m.start(), m.end()) for k in pii.BASE
            for m in re.finditer(pii.PLAIN[k], text or "") if ok[k](m.group())]


CASES = [
    "x a@b.co_m@x.yz y", "a@b@c.d.e", "..a@-.-", "1.2.3.4.5.6.7.8", "999.1.2.3.4.5.6.7", "001.02.3.255",
    "256.1.1.1 1.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111 5", "4111111111111111-4",
    "12 4111111111111111", "4111  1111 1111 1111", "3782 822463 10005 0", "+1 (555) 123-4567 x",
    "+12345678", "+1234567", "++49 30 1234567.", "+1 ) ) ) 2", "é" * 5 + "a@b.cd", "a" * 3000 + "@", "\U0001f600 +4930123456",
    "1" * 5000, "1 " * 3000, "9" * 19 + " " + "4111111111111111", "1.1.1.1" * 30,
]


def test_pii_base_spans_are_the_contract(spark, odd):
    rng = random.Random(1)
    noise = ["".join(rng.choice("12.@+- ()ab") for _ in range(60)) for _ in range(400)]
    rows = [(i, t) for i, t in enumerate(CASES + noise)]
    df = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    texts = {r.doc_id: r.text for r in odd.select("doc_id", "text").collect()}
    got = pii.find_spans(df).collect()
    seen = Counter()
    for r in got:
        spans = [(s.kind, s.start, s.end) for s in r.spans if s.kind in pii.BASE]
        seen[(r.doc_id, tuple(spans))] += 1
    want = Counter((d, tuple(base_spans(t))) for d, t in
                   rows + [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])
    assert seen == want and texts[8] is not None


def test_pii_added_kinds_need_their_proof(spark):
    rows = [(1, "IBAN GB82 WEST 1234 5698 7654 32 ok"), (2, "IBAN GB83 WEST 1234 5698 7654 32 ok"),
            (3, "his ssn is 078-05-1120."), (4, "part 078-05-1120 of"), (5, "DE89370400440532013000")]
    got = {r.doc_id: [(s.kind, s.text) for s in r.spans] for r in pii.find_spans(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == [("iban", "GB82 WEST 1234 5698 7654 32")] and got[2] == []
    assert got[3] == [("ssn", "078-05-1120")] and got[4] == []
    assert got[5] == [("iban", "DE89370400440532013000")]


def test_pii_context_lifts_the_score(spark, none):
    rows = [(1, "call +1 555 123 4567"), (2, "sold +1 555 123 4567")]
    a, b = pii.find_spans(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert a.spans[0].score > b.spans[0].score
    assert pii.find_spans(none).count() == 0


def test_chat_round_trip(spark):
    t = chat.Template()
    rng = random.Random(2)
    parts = ["\\", "###", "</turn>", ":\n", "### ", "a", "\n", "#", "<", "\\\\", "é", ""]
    rows, want = [], {}
    for conv in range(60):
        turns = []
        for i in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "system", "r:\n###", ""])
            text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
            rows.append((conv, i, role, text, "x"))
            turns.append((role, text))
        loss = "".join(x for r, x in turns if r == "assistant")
        shown = t.between.join(t.header(r) + t.quote(x) + t.closing for r, x in turns)
        want[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(),
                      len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(shown))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq string")
    segments = chat.format_conversations(df.repartition(7))
    got = {r.conv_id: tuple(r)[1:6] for r in chat.read_back(segments).collect()}
    assert got == want


def test_chat_machine_marks_the_first_bad_turn(spark):
    rows = [(1, 0, "system"), (1, 1, "user"), (1, 2, "assistant"), (2, 0, "user"), (2, 1, "user"),
            (3, 0, "assistant"), (4, 0, "user"), (4, 1, "wizard"), (None, None, None), (None, 0, "user")]
    df = spark.createDataFrame([(*r, None) for r in rows], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.n_turns, r.bad_turn) for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert got == {1: (3, -1), 2: (2, 1), 3: (1, 0), 4: (2, 1), None: (2, 1)}
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_nnpu_separates_without_clean_labels():
    rng = np.random.default_rng(0)

    def doc(toxic):
        words = set(rng.integers(10, 200, 12).tolist())
        return np.array(sorted(words | (set(rng.choice(8, 2).tolist()) if toxic else set())))

    toxic = [doc(True) for _ in range(200)]
    mixed = [doc(i % 10 == 0) for i in range(1000)]
    w, b = toxicity.fit_nnpu(toxic, mixed, 0.1, 200)
    score = [b + w[d].sum() for d in mixed]
    assert np.mean([(s > 0) == (i % 10 == 0) for i, s in enumerate(score)]) > 0.95


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = toxicity.score_toxicity(docs, toxicity.train_side(docs, labels))
    rows = scored.join(labels, "doc_id").where(toxicity.held_out(scored.doc_id)).collect()
    assert len(rows) > 500 and all(0 <= r.score <= 1 for r in rows)
    hit = [(r.score >= 0.5, r.toxic == 1) for r in rows]
    assert np.mean([a == b for a, b in hit]) > 0.97
    assert np.mean([b for a, b in hit if a]) > 0.95
    assert np.mean([a for a, b in hit if b]) > 0.75


def test_toxicity_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(odd, labels)
    rows = toxicity.score_toxicity(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    kept = toxicity.reject_toxic(odd, toxicity.ToxicModel({"one": 9.0}, -4.0))
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    empty = toxicity.train_toxicity(none, labels.limit(0))
    assert toxicity.score_toxicity(none, empty).count() == 0
    assert {r.score for r in toxicity.score_toxicity(odd, empty).collect()} == {0.0}


def edited_pairs(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    for i, (d, t) in enumerate(rows):
        x = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        yield d, t, t[:len(t) - half] + x[:half], x


def test_fingerprints_follow_edits(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in fingerprint.op6_fingerprint(spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    near, far = [], []
    for d, t, edited, x in edited_pairs(rows):
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_next <= 1 and (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1)
        near.append(r.near_edited)
        far.append(r.near_next)
    assert np.mean(near) > np.mean(far) + 0.08


def order_minhash(text):
    """The signature rule with Python lists, over the k-mers themselves."""
    units = re.findall(r"[^ \t\n\x0b\f\r]{1,8}[ \t\n\x0b\f\r]*|[ \t\n\x0b\f\r]+", text)
    seen, kmers = Counter(), []
    for i in range(len(units)):
        k = tuple(units[i:i + fingerprint.K])
        kmers.append((k, seen[k]))
        seen[k] += 1
    return kmers


def test_pii_context_crosses_other_matches(spark):
    text = "ssn 1.2.3.4 078-05-1120 and 219-09-9999, " + "no word near by, only filler text " * 2 + "457-55-5462"
    got = pii.find_spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [s.text for s in got.spans if s.kind == "ssn"] == ["078-05-1120", "219-09-9999"]


def test_pii_many_spans_in_one_text(spark):
    text = "é a.b@c.de 10.0.0.1 " * 100_000
    start = time.time()
    got = pii.find_spans(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"))
    spans = {r.doc_id: r.spans for r in got.collect()}
    assert time.time() - start < 60 and spans[2] == []
    assert [(s.kind, s.start, s.end) for s in spans[1]] == base_spans(text)


def spark_hash(seed, *values):
    """xxhash64 of Spark: each value's hash is the seed of the next."""
    import xxhash
    for v in values:
        if v is not None:
            raw = v.encode() if isinstance(v, str) else v.to_bytes(4 if isinstance(v, I32) else 8, "little", signed=True)
            seed = xxhash.xxh64_intdigest(raw, seed)
    return seed


class I32(int):
    pass


def signature_brute(text):
    """Numbered k-mers, the two smallest of each slot, in text order."""
    units = re.findall(r"[^\s]{1,8}\s*|\s+", text, re.ASCII)
    slots, seen = {}, Counter()
    for i in range(len(units)):
        key = spark_hash(42, *units[i:i + fingerprint.K]) >> 32
        o = seen[key]
        seen[key] += 1
        if o:
            key = spark_hash(42, key, I32(o)) >> 32
        slots.setdefault(key >> 26, []).append((key, i))
    out = []
    for slot in sorted(slots):
        two = sorted(sorted(slots[slot])[:2], key=lambda x: x[1])
        value = spark_hash(42, *(k for k, _ in two))
        out.append((value >> 32) << 6 | slot)
    return out


def test_signature_is_the_brute_force(spark):
    rng = random.Random(3)
    texts = ["", "x", " \t", "a b", "x " * 500, "ab cd ef " * 40]
    texts += [" ".join(rng.choice(["é", "w", "longerword", "b\n", "漢字"]) * rng.randint(1, 2)
                       for _ in range(rng.randint(1, 300))) for _ in range(40)]
    df = fingerprint.with_signature(spark.createDataFrame(list(enumerate(texts)), "doc_id long, t string"), "t", "sig")
    got = {r.doc_id: r.sig for r in df.collect()}
    assert [got[i] for i in range(len(texts))] == [signature_brute(t) for t in texts]


def test_signature_keeps_order_in_very_long_texts(spark):
    """Halves exchanged beyond the first 2^20 units still show."""
    words = F.transform(F.sequence(F.lit(1), F.lit(1_400_000)), lambda i: F.concat(F.lit("w"), i.cast("string"), F.lit(" ")))
    df = spark.range(1).select(words.alias("w"))
    low, a, b = (F.array_join(F.slice("w", s, n), "") for s, n in ((1, 1_100_000), (1_100_001, 150_000), (1_250_001, 150_000)))
    df = df.select(F.concat(low, a, b).alias("t"), F.concat(low, b, a).alias("u"))
    df = fingerprint.with_signature(fingerprint.with_signature(df, "t", "s1"), "u", "s2")
    r = df.select(fingerprint.likeness("s1", "s2").alias("z")).first()
    assert r.z < 1


def test_signature_depends_on_numbered_kmers_and_their_order(spark):
    words = [f"w{i}" for i in range(40)]
    swapped = words[20:] + words[:20]
    texts = {"a": " ".join(words), "b": " ".join(swapped), "c": " ".join(words * 2), "d": " ".join(words * 3),
             "e": "x " * 500, "f": "x " * 499, "g": "", "h": "x"}
    df = spark.createDataFrame(list(texts.items()), "doc_id string, t string")
    df = fingerprint.with_signature(df, "t", "sig")
    sig = {r.doc_id: r.sig for r in df.collect()}
    both = df.selectExpr("doc_id as x", "sig as s1").crossJoin(df.selectExpr("doc_id as y", "sig as s2"))
    like = {(r.x, r.y): r.z for r in both.select("x", "y", fingerprint.likeness("s1", "s2").alias("z")).collect()}
    assert all(like[(k, k)] == 1 for k in texts) and like[("g", "h")] == 0
    assert 0 < like[("a", "b")] < 1  # moved halves: same k-mers, other order
    assert sig["c"] != sig["d"] and sig["a"] != sig["c"]  # repeated k-mers count
    assert like[("e", "f")] > 0.9
    for k, t in texts.items():
        assert len(sig[k]) <= min(fingerprint.SLOTS, len(order_minhash(t)))


def test_fingerprint_odd_rows(spark, odd, none):
    got = fingerprint.fingerprints(odd).collect()
    assert len(got) == odd.count() and len({r.fingerprint for r in got if r.doc_id in (6, 7)}) == 1
    plain = odd.selectExpr("doc_id", "coalesce(text, '') as t")
    rows = fingerprint.with_next(fingerprint.with_signature(plain, "t", "sig")).collect()
    assert len(rows) == odd.count() and all(r.next_t is not None for r in rows)
    follow = {r.doc_id: r.next_t for r in rows}
    assert follow[9].startswith("mail") and follow[7] == LONG and follow[2] == ""
    empty = fingerprint.with_next(fingerprint.with_signature(none.selectExpr("doc_id", "text as t"), "t", "sig"))
    assert empty.count() == 0
    one = spark.createDataFrame([(1, "a b c")], "doc_id long, t string")
    assert fingerprint.with_next(fingerprint.with_signature(one, "t", "sig")).first().next_t == "a b c"


@pytest.mark.parametrize("frequent", [3, 1 << 18])
def test_lm_base_and_marginals(spark, docs, odd, frequent):
    df = docs.select("doc_id", "text").limit(60).union(odd.select("doc_id", "text"))
    df = df.withColumn("held_out", lm_score.held_out(df.doc_id))
    rows = [(r.doc_id, r.text or "", r.held_out) for r in df.collect()]
    count = Counter()
    for d, t, out in rows:
        assert out == (zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0)
        if not out:
            count.update([*lm_score.words_of(t), b""])
    n, v = sum(count.values()), len(count)
    table, total = lm_score.word_table(df)
    lp = {bytes(r.word): r.lp for r in table.collect()}
    assert total == n
    want = sorted((d is None, d or 0, len(w), sum(count[x] > 0 for x in w),
                   sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), sum(lp[x] for x in w))
                  for d, t, _ in rows for w in [[*lm_score.words_of(t), b""]])
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.base_score, r.score)
                 for r in lm_score.score_documents(df, frequent=frequent).collect())
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)


def test_lattice_sums_all_segmentations():
    pieces = [b"", b" ", b"a", b"b", b"ab", b" a", b" ab", b"ba", *[bytes([i]) for i in range(256) if i not in b" ab"]]
    p = np.arange(1, len(pieces) + 1) / 1e5
    weight = dict(zip(pieces, p))

    def total(s):
        return 1.0 if not s else sum(weight[s[:k]] * total(s[k:]) for k in range(1, len(s) + 1) if s[:k] in weight)

    lattice = lm_score.Lattice(pieces, np.log(p))
    words = [b"a", b"ab", b"abab", b"bbaab", b"ab", "é".encode(), b"q" * 30, b"ab" * 8]
    assert lattice.words(words) == pytest.approx([math.log(total(b" " + w)) for w in words], rel=1e-9)
    assert lattice.words([b""])[0] == pytest.approx(math.log(p[0]))
    assert np.isfinite(lattice.words([b"ab" * 50_000])[0])


def test_lm_model_is_a_distribution_learned_from_training_only(spark, none):
    rows = [(i, "the cat sat on the mat") for i in range(40)] + [(100, "zyx zyx")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumn("held_out", df.doc_id == 100)
    got = {r.doc_id: r for r in lm_score.score_documents(df).collect()}
    assert got[100].n_known == 1 and got[1].score > got[100].score
    empty = none.select("doc_id", "text").withColumn("held_out", lm_score.held_out(none.doc_id))
    assert lm_score.score_documents(empty).count() == 0
