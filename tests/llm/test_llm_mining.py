"""Collocations, ranked search and secret scans."""

import math
import random
import re
from collections import Counter
from fractions import Fraction

import pytest
from conftest import CLASHES, SCHEMA, table

from tokloom.llm import collocations, search, secret_scan


# --- collocations ---------------------------------------------------------

def phrases(rows, min_count, share, top):
    """Brute force over (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            ws = re.findall("[^\x20\t]+", piece)
            n[lang] += len(ws)
            for k in (1, 2, 3):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i:i + k])] += 1
    found = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= min_count:
            cuts = [(math.floor(Fraction(1000000 * a * a, f[lang, p[:k]] * f[lang, p[k:]])), k)
                    for k in range(1, len(p))]
            score, k = min(cuts)
            found[lang, p] = (score, a, f[lang, p[:k]], f[lang, p[k:]])
    kept = {x: v for x, v in found.items()
            if not any(lang == x[0] and len(q) == 3 and len(x[1]) == 2 and x[1] in (q[:2], q[1:])
                       and 100 * w[1] >= share * v[1] for (lang, q), w in found.items())}
    out = []
    for lang in {x[0] for x in kept}:
        own = sorted((-v[0], -v[1], " ".join(p).encode(), v) for (g, p), v in kept.items() if g == lang)
        out += [(lang, i + 1, p.decode(), v[1], v[2], v[3], n[lang], v[0])
                for i, (_, _, p, v) in enumerate(own[:top])]
    return sorted(out)


def pairs_of(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


@pytest.fixture(scope="module")
def babble(spark):
    rng = random.Random(5)
    words = ["the", "The", "of", "é", "漢字", "x\x1cy", "zz b", "New", "york", "times", "a", "b"]
    rows = []
    for i in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "\t", "  ", ". ", "\n", ", "])
                       for _ in range(rng.randrange(60)))
        rows.append((i, rng.choice(["en", "de", None]), text + rng.choice(["new york times", ""])))
    return spark.createDataFrame(rows, "doc_id long, lang string, text string")


@pytest.mark.parametrize("size", [None, 7])
def test_collocations_are_the_brute_force(spark, babble, monkeypatch, size):
    if size:  # chunks that end inside pieces
        class Small(collocations._Chunk):
            def full(self):
                return len(self.ids) >= self.lead + size
        real = collocations._encode

        def encode(batches):
            collocations._Chunk = Small
            return real(batches)
        monkeypatch.setattr(collocations, "_encode", encode)
    got = sorted(map(tuple, collocations.collocations(babble, 3, 50, 12).collect()))
    want = phrases(pairs_of(babble, "lang", "text"), 3, 50, 12)
    assert got == want and len(got) == 36


def test_collocations_odd_rows(spark, odd, none):
    got = sorted(map(tuple, collocations.collocations(odd).collect()))
    assert got == phrases(pairs_of(odd, "lang", "text"), 10, 50, 2000)
    assert any(r[2] == "lorem ipsum dolor" for r in got)
    assert collocations.collocations(none).count() == 0


def test_chunk_context_and_slices():
    long = b"a bb. ccc " * 1000
    assert [w for ws in collocations.word_runs(long, 64) for w in ws] == \
        [w for ws in collocations.word_runs(long, 1 << 20) for w in ws]
    held = collocations._Chunk()
    held.add("en", [b"a", b".", b"b"])
    assert held.context() == [("en", b"b")]
    held.add("en", [b"c"])
    assert held.context() == [("en", b"b"), ("en", b"c")]
    held.ids.append(0)
    assert held.context() == []


def test_scores_are_exact(spark):
    big = 9_007_199_254_740_993
    df = spark.createDataFrame([(big, big + 2, big + 6)], "a long, l long, r long")
    got = df.select(collocations._score("a", "l", "r").alias("s")).first().s
    assert got == 1000000 * big * big // ((big + 2) * (big + 6))


# --- search ---------------------------------------------------------------

TERM = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def ranking(docs, items, top):
    """Brute force: all scores of all documents."""
    counts = [(d, Counter(re.findall(TERM, lower(t)))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    big_n, big_l = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for d, c in counts:
            m = 50 + 50 * sum(c.values()) * big_n // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    * (1000000000 * c[t] // (1000 * c[t] + 20 * m))
                    for t in set(re.findall(TERM, lower(text))) if c[t])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored, key=lambda x: x[:3])[:top])]
    return Counter(out)


@pytest.mark.parametrize("sample,shard,run", [(64, 4096, 64), (4, 50, 8)])
def test_search_is_the_brute_force(spark, monkeypatch, sample, shard, run):
    rng = random.Random(3)
    words = ["w%d" % i for i in range(60)] + ["É", "Ab", "x-y", "漢"]
    weights = [1 / (i + 1) for i in range(len(words))]

    def text(n):
        return " ".join(rng.choices(words, weights, k=n))

    docs = [(i // 2 if i % 7 else None, text(rng.randrange(0, 80))) for i in range(600)]
    docs += docs[:20] + [(7, None), (8, ""), (9, "  \t")]
    items = [(i, text(rng.randrange(0, 25))) for i in range(12)] + [(3, "w1 w2 w60"), (None, "w5 W5"), (50, None)]
    items.append(items[0])
    for name, value in (("SAMPLE", sample), ("SHARD_DOCS", shard), ("RUN_DOCS", run)):
        monkeypatch.setattr(search, name, value)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    queries = spark.createDataFrame(items, "item_id long, text string")
    got = Counter(map(tuple, search.search(df, queries, 10).collect()))
    assert got == ranking(docs, items, 10)


def test_search_in_several_batches_and_odd_rows(spark, odd, none, monkeypatch):
    monkeypatch.setattr(search, "BATCH_ITEMS", 2)
    items = [(1, "one lorem"), (2, "mail DOLOR 漢字"), (3, ""), (4, "nowhere"), (5, "x é")]
    queries = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, rank string")
    got = Counter(map(tuple, search.search(odd, queries).collect()))
    assert got == ranking([(r.doc_id, r.text) for r in odd.collect()], items, 50)
    assert search.search(none, queries).count() == 0
    assert search.search(odd, queries.where("false")).count() == 0


def test_joint_maxima_are_tighter():
    import numpy as np
    vocabulary = {b"a": 0, b"b": 1}
    batch = search.Batch([(1, "a b")], {0: 2, 1: 2, search.N_DOCS: 4, search.N_TERMS: 40}, vocabulary)
    shard = search.Shard(batch, np.array([10, 10]), np.array([0, 1], np.int32), np.array([3, 3], np.int32),
                         np.array([0, 1, 2]))
    single = sum(int(shard.postings(t)[1].max()) for t in (0, 1))
    assert shard.joint[0, 0] * 2 == single  # they never meet
    assert len(shard.search(batch.items[0][1], int(shard.joint[0, 0]) + 1)[0]) == 0


# --- secrets --------------------------------------------------------------

def base(text):
    out = []
    for k, (kind, least) in enumerate(secret_scan.LEAST.items()):
        flags = re.IGNORECASE | re.ASCII if kind == "assign" else 0
        for m in re.finditer(secret_scan.PLAIN[kind], text or "", flags):
            value = m.group(2) if kind == "assign" else m.group()
            if len(value) >= least:
                out.append((m.start(), k, kind, m.end()))
    return [(kind, s, e) for s, _, kind, e in sorted(out)]


SECRETS = ["token = \"abc123\"", "TOKEN:short", "apikey==xyz=/+._-", "Api_Key : 'q1w2e3r4'", "é" * 9 + "password=hunter22",
           "passwordpassword=secret=token:abcdef", "AKIA" + "Z9" * 8, "AKIAAKIA" + "A" * 11, "AKIA" + "A" * 15 + "a",
           "deadbeef" * 3, "deadbeef" * 2 + "G" + "cafe" * 6, "f" * 23, "ſecret=abcdefg", "toKen=abcdefg",
           "secret \x20 = \x20 \"aaaaaa\"bbbb", "token=\"'abcdefg", "x" * 5000 + "0" * 5000]


def test_secret_base_spans_are_the_contract(spark, odd):
    rng = random.Random(2)
    noise = ["".join(rng.choice(["token", "=", ":", " ", "'", "AKIA", "A1B2C3D4", "0a1b2c3d", "_", "key", "api", "é"])
                     for _ in range(40)) for _ in range(400)]
    rows = list(enumerate(SECRETS + noise))
    df = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    got = Counter((r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans if s.kind in secret_scan.BASE))
                  for r in secret_scan.find_secrets(df).collect())
    assert got == Counter((r.doc_id, tuple(base(r.text))) for r in df.collect())


def planted(rng, n):
    """Labelled credentials of two formats, unlabelled ones, and other runs."""
    token = lambda: "tk_" + "".join(rng.choice("abcdefghijkmnpqrstuvwxyz23456789") for _ in range(24))
    other = lambda: "".join(rng.choice("0123456789") for _ in range(16))
    rows = []
    for i in range(n):
        rows.append((3 * i, f"set token = \"{token()}\" here", 1))
        rows.append((3 * i + 1, f"we saw {token()} in the log", 2))
        rows.append((3 * i + 2, f"order {other()} and internationalisation{i % 10}", 0))
    return rows


def test_learned_formats_find_unlabelled_credentials(spark):
    rows = planted(random.Random(4), 200)
    df = spark.createDataFrame(rows, "doc_id long, text string, want int")
    got = {r.doc_id: [s.kind for s in r.spans] for r in secret_scan.find_secrets(df).collect()}
    assert all(got[d] == ["assign"] for d, _, w in rows if w == 1)
    found = sum(got[d] == [secret_scan.LEARNED] for d, _, w in rows if w == 2)
    false = sum(bool(got[d]) for d, _, w in rows if w == 0)
    assert found >= 0.8 * 200 and false <= 2


def test_automaton_keeps_fixed_parts_and_loops_free_ones():
    rng = random.Random(1)
    values = ["AKIA" + "".join(rng.choice("ABCDEFGH01234567") for _ in range(16)) for _ in range(500)]
    a = secret_scan.Automaton(values)
    assert 5 <= len(a.to) <= 30
    fresh = ["AKIA" + "".join(rng.choice("ABCDEFGH01234567") for _ in range(16)) for _ in range(50)]
    wrong = ["".join(rng.choice("ABCDEFGH01234567") for _ in range(20)) for _ in range(50)]
    assert min(map(a.bits, fresh)) > max(map(a.bits, wrong))


def test_secrets_odd_rows(spark, odd, none):
    twice = secret_scan.find_secrets(odd)
    assert twice.count() == odd.count() and secret_scan.find_secrets(none).count() == 0
    assert not any(r.spans for r in twice.collect())
    assert set(CLASHES) < {f.split()[0] for f in SCHEMA.split(", ")} and table(spark, []).count() == 0
