"""Exact dedup, line dedup and the n-gram join against brute force."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
from conftest import LONG, table

from tokloom.llm import exact_dedup, line_dedup, ngram_join
from tokloom.llm.components import connected_components


def exact_brute(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    out = []
    for t, ids in groups.items():
        top = max((d for d in ids if d is not None), default=None)
        left = 1
        for d in ids:
            out.append((d, top, len(ids), bool(d == top and left), hashlib.sha256(t.encode()).hexdigest()))
            left -= d == top and left
    return Counter(out)


def test_exact_groups_over_many_blocks(spark, odd, docs):
    for df, block in ((odd, 4096), (docs, 64), (docs, 1)):
        if block == 1:
            df = df.limit(8).selectExpr("doc_id", "substr(text, 1, 40) as text")
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        got = exact_dedup.exact_groups(df, block=block)
        assert Counter(tuple(r) for r in got.select(
            "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == exact_brute(rows)


def test_exact_tells_shifted_blocks_apart(spark):
    rows = [(1, "ab" * 50), (2, "ba" * 50), (3, "ab" * 50 + "a"), (4, "ab" * 50), (5, "ab" * 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.keep_id for r in exact_dedup.exact_groups(df, block=8).collect()}
    assert got == {1: 4, 2: 2, 3: 3, 4: 4, 5: 5}


def test_exact_empty_table(none):
    assert exact_dedup.exact_groups(none).count() == 0


def words_brute(rows, need=50):
    """{id: (text, words deleted)} of rows with different ids."""
    first, out = {}, {}
    for d, t in sorted(rows):
        pieces = [m.group() for m in re.finditer("[^\x20\t-\r]+[\x20\t-\r]*", t)]
        head = t[:len(t) - sum(map(len, pieces))]
        words, cut = t.encode().split(), set()
        for i in range(len(words) - need + 1):
            x, at = first.setdefault(tuple(words[i:i + need]), (d, i))
            if x != d or i >= at + need:
                cut |= set(range(i, i + need))
        out[d] = (head + "".join(p for i, p in enumerate(pieces) if i not in cut), len(cut))
    return out


def deduped(df):
    return {r.doc_id: (r.text, r["__n_removed"]) for r in line_dedup.delete_runs(df).collect()}


def test_line_dedup_is_the_brute_force(spark):
    rng = random.Random(5)

    def words(n):
        return "".join(rng.choice(["é", "b", "c", "漢", "e"]) * rng.randint(1, 3) + rng.choice([" ", "\n", " \t", " "])
                       for _ in range(n))

    pool = [words(rng.randint(1, 90)) for _ in range(25)]
    rows = [(d, rng.choice(["", " \n"]) + "".join(rng.choice(pool) for _ in range(rng.randint(1, 9))))
            for d in range(120)]
    rows += [(200, pool[3] * 30), (201, " ".join(["w"] * 60) + "\nshort"), (202, "other\n" + " ".join(["w"] * 160)),
             (203, rows[7][1]), (204, rows[7][1]), (205, words(49)), (206, "\x1c " * 70)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got, want = deduped(df), words_brute(rows)
    assert got == want and sum(n > 0 for _, n in got.values()) > 60


def test_line_dedup_finds_passages_inside_lines(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    passages = [" ".join(word() for _ in range(rng.randint(51, 80))) for _ in range(30)]
    rows = [(d, " ".join([word() for _ in range(rng.randint(0, 60))] + [passages[d % 30]]
                         + [word() for _ in range(rng.randint(0, 60))])) for d in range(120)]
    got = deduped(spark.createDataFrame(rows, "doc_id long, text string"))
    for d, t in rows:
        assert (passages[d % 30] in got[d][0]) == (d < 30)
        assert got[d][1] == (0 if d < 30 else len(passages[d % 30].split()))


def test_line_dedup_keeps_the_first_of_overlapping_runs(spark):
    line = " ".join(f"w{i}" for i in range(20))
    rows = [(1, "\n".join([line] * 4)), (2, "\n".join([line] * 10))]
    got = deduped(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got[1] == (rows[0][1], 0) and got[2] == ("", 200)


def test_line_dedup_is_linear_in_odd_texts(spark):
    blank = "\n" * 200_000 + " ".join(f"v{i}" for i in range(60))
    same = "z " * 200_000
    start = time.time()
    got = deduped(spark.createDataFrame([(1, blank), (2, blank + " x"), (3, same)], "doc_id long, text string"))
    assert time.time() - start < 30
    assert got[1] == (blank, 0) and got[2] == ("\n" * 200_000 + "x", 60) and got[3][1] == 199_950


def test_line_dedup_odd_rows(odd, none):
    got = line_dedup.delete_runs(odd)
    assert got.columns == [*odd.columns, "__n_removed"]
    rows = {(r.doc_id, r.lang): (r.text, r["__n_removed"]) for r in got.collect()}
    assert rows[(1, "en")] == (None, 0) and rows[(2, "en")] == ("", 0) and got.count() == odd.count()
    assert rows[(6, "en")] == words_brute([(6, LONG)])[6] and rows[(7, "en")] == ("", 200_001)
    assert line_dedup.delete_runs(none).count() == 0


def grams(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else (
        frozenset([tuple(w)]) if w else frozenset())


def join_brute(rows, n, percent):
    sets = [(d, grams(t, n)) for d, t in rows]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            o = len(a & b)
            if a and b and 100 * o >= percent * (len(a) + len(b) - o):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(sets):
        ids[find(i)].append(d)
    return Counter((d, len(s), min((x for x in ids[find(i)] if x is not None), default=None))
                   for i, (d, s) in enumerate(sets))


def variants(rng, words, n, edits):
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_ngram_join_is_the_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 16)
    rng = random.Random(3)
    base = [f"w{rng.randrange(400)}" for _ in range(150)]
    texts = variants(rng, base, 60, 4) + variants(rng, base[:40], 20, 2) + variants(rng, base[:12], 15, 1)
    texts += [" ".join(base[i:i + n]) for n in (1, 2, 3, 4, 5, 11, 20, 21, 22) for i in range(3)]
    texts += ["", " ", None, "A b C", "a B c", "a b c"]
    rows = list(enumerate(texts)) + [(None, "a b c"), (3, texts[3]), (None, "alone in the world")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for n, percent in ((3, 90), (5, 80)):
        got = ngram_join.ngram_components(df, n, percent)
        assert Counter(tuple(r) for r in got.collect()) == join_brute(rows, n, percent)


def test_keys_of_linked_sets_meet():
    rng = np.random.default_rng(1)
    p = ngram_join.Positions(90)
    for n in [*range(1, 60), 200, 1000]:
        x = rng.integers(0, 2**63, n).astype(np.uint64)
        for _ in range(5):
            y = x[: n - n // 10] if rng.random() < 0.5 else np.append(
                x, rng.integers(0, 2**63, n // 10).astype(np.uint64))
            if 100 * min(len(x), len(y)) >= 90 * max(len(x), len(y)):
                (kx, nx), (ky, ny) = p.keys(np.unique(x)), p.keys(np.unique(y))
                need = dict(zip(kx.tolist(), nx.tolist()))
                both = [max(need[k], m) for k, m in zip(ky.tolist(), ny.tolist()) if k in need]
                assert both and len(both) >= min(both)


def threshold_pairs(rng, percent, n):
    """Pairs of word lists of 5 to 50 words that differ as much as linked ones can."""
    while n:
        size = int(rng.integers(5, 51))
        drop = int(rng.integers(0, size))
        add = 100 * (size - drop) // percent - size
        if add >= 0:
            x = [f"{w:x}" for w in rng.integers(0, 2**63, size + add)]
            yield " ".join(x[:size]), " ".join(x[drop:])
            n -= 1


def test_threshold_pairs_are_candidates(monkeypatch):
    import pyarrow as pa
    import pyspark
    m = 20_000
    for percent in (80, 90):
        index = []
        for task, texts in enumerate(zip(*threshold_pairs(np.random.default_rng(1), percent, m))):
            monkeypatch.setattr(pyspark.TaskContext, "get", lambda task=task: type(
                "Task", (), {"partitionId": lambda self: task})())
            batch = pa.RecordBatch.from_pydict({"doc_id": list(range(m)), "rkey": [""] * m, "text": texts})
            index += [b for b in ngram_join._index_batches([batch], 1, percent) if b.column("key").null_count == 0]
        rows = pa.Table.from_batches(index).sort_by([("key", "ascending"), ("set", "ascending")])
        read = [[b.column(c).to_pylist() for c in range(4)]
                for b in ngram_join._read_lists(rows.combine_chunks().to_batches())]
        pairs, root = [r for cols in read for r in zip(*cols)], {}

        def find(i):
            while root.get(i, i) != i:
                root[i] = root.get(root[i], root[i])
                i = root[i]
            return i

        for x, y, _, least in pairs:
            if least == 0:
                root[find(x)] = find(y)
        count, need = Counter(), {}
        for x, y, n, least in pairs:  # as _families adds them up
            two = frozenset((find(x), find(y)))
            if least:
                count[two] += n
                need[two] = min(least, need.get(two, least))
        lost = 0
        for i in range(m):
            two = frozenset((find(i), find(i + (1 << 40))))
            lost += len(two) == 2 and count[two] < need.get(two, 1)
        assert not lost, (percent, lost)


def test_block_links_counts_like_sets():
    rng = np.random.default_rng(2)
    base = np.arange(100, dtype=np.uint64)
    sets = [np.unique(np.append(rng.choice(base, 100 - rng.integers(0, 12), replace=False),
                                rng.integers(1000, 9999, rng.integers(0, 6)).astype(np.uint64)))
            for _ in range(40)]
    stars = ngram_join.block_links(sets, 90, columns=7)
    root = list(range(40))
    for i, j in stars:
        root[j] = i
    near = {i: {i} for i in range(40)}
    for i in range(40):
        for j in range(40):
            o = len(np.intersect1d(sets[i], sets[j]))
            if 100 * o >= 90 * (len(sets[i]) + len(sets[j]) - o):
                near[i].add(j)
    seen = {}
    for i in range(40):
        if i not in seen:
            todo, seen[i] = [i], i
            while todo:
                for j in near[todo.pop()]:
                    if j not in seen:
                        seen[j] = i
                        todo.append(j)
    assert root == [seen[i] for i in range(40)]


def test_keep_one_keeps_columns_and_clean_rows(spark, odd, none):
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id if r.doc_id is not None else -1, r.text is None) for r in kept.collect())
    # of "one" the smallest id, of the long texts the smaller, all rows without words
    assert ids == [(-1, True), (1, True), (2, False), (3, False), (4, False), (6, False), (8, False),
                   (9, False)]
    assert ngram_join.keep_one(none).count() == 0
    assert ngram_join.ngram_components(none).count() == 0
    twice = table(spark, [(1, "a b c d e f", "s")] * 3)
    assert ngram_join.keep_one(twice).count() == 1


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.v: r.root for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_links_at_the_edge_are_whole_numbers():
    """671 121 shared of 745 690 n-grams are exactly 90 percent; a third set
    in the block changes nothing."""
    x = np.arange(0, 708_405, dtype=np.uint64)
    y = np.concatenate([x[:671_121], np.arange(1 << 40, (1 << 40) + 37_285, dtype=np.uint64)])
    z = np.arange(1 << 50, (1 << 50) + 5, dtype=np.uint64)
    assert len(np.union1d(x, y)) * 90 <= len(np.intersect1d(x, y)) * 100
    assert ngram_join.block_links([x, y], 90) == [(0, 1)]
    assert ngram_join.block_links([x, y, z], 90) == [(0, 1)]


def test_a_common_passage_unites_no_families(spark, monkeypatch):
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(12)]
    texts = [" ".join([f"w{rng.randrange(10**9)}" for _ in range(rng.randint(185, 205))] + passage) for _ in range(300)]
    texts += [texts[0] + " more", texts[1] + " more words"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    sizes, write = [], ngram_join.staged

    def staged(df, label):
        out = write(df, label)
        if label == "holders":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "staged", staged)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 16)
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_components(df, 5, 80).collect()}
    assert got == {i: {300: 0, 301: 1}.get(i, i) for i in range(302)}
    assert sizes[-1] < 60  # the pairs; small families, which chance keys give, are not dealt again


def pair_rows(spark, monkeypatch, texts):
    """(component of every text, rows of pairs of sets that were made)"""
    made, read = spark.sparkContext.accumulator(0), ngram_join._read_lists

    def counted(batches):
        for batch in read(batches):
            made.add(sum((need or 0) > 0 for need in batch.column("need").to_pylist()))
            yield batch

    with monkeypatch.context() as m:
        m.setattr(ngram_join, "_read_lists", counted)
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
        got = {r.doc_id: r.component_id for r in ngram_join.ngram_components(df, 5, 80).collect()}
    return got, made.value


def test_sets_that_share_too_little_make_no_pairs(spark, monkeypatch):
    rng = random.Random(7)

    def words(n):
        return [f"w{rng.randrange(10**9)}" for _ in range(n)]

    passages = [words(90) for _ in range(20)]
    texts = [" ".join(words(110) + passages[i % 20]) for i in range(240)]  # twelve on each passage
    texts.append(texts[3] + " more")
    got, rows = pair_rows(spark, monkeypatch, texts)
    assert got == {i: {240: 3}.get(i, i) for i in range(241)}
    assert rows < 5 * 240


def test_groups_united_by_long_lists_make_no_pairs(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"b{i}" for i in range(300)]
    texts = variants(rng, base, 400, 1)
    for i in range(400):  # edits that some others have too
        w = texts[i].split(" ")
        w[rng.randrange(300)] = f"e{rng.randrange(2)}"
        texts[i] = " ".join(w)
    got, rows = pair_rows(spark, monkeypatch, texts)
    assert set(got.values()) == {0}
    assert rows < 400


def test_met_rows_across_batches():
    import pyarrow as pa
    key = [1, 2, 2, 3, 4, 4, 4, 5, 6, 6]
    index = ngram_join._index_rows(np.array(key), np.arange(10), np.full(10, 9))
    for size in range(1, 11):
        rows = pa.Table.from_batches(ngram_join._met_rows([index.slice(i, size) for i in range(0, 10, size)]))
        assert rows.column("set").to_pylist() == [1, 2, 4, 5, 6, 8, 9], size
