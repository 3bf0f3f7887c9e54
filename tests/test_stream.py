import pytest
from pyspark.sql import functions as F
import random

from tokloom.operators import positions as P
from tokloom.operators import stream as S
from tokloom.operators.fim import collate, fim_samples


def make_stream(spark, lengths, seed=1):
    rnd = random.Random(seed)
    docs = [(i, [rnd.randrange(100, 200) for _ in range(n)]) for i, n in enumerate(lengths)]
    df = spark.createDataFrame(docs, "doc_id long, ids array<int>")
    flat = [x for _, ids in docs for x in ids]
    return S.stream_offsets(df, ["doc_id"]), flat


def test_split_sizes():
    for n in (1, 10, 199, 200, 201):
        for r in (0, 0.005, 0.9):
            tr, va, rr = S.split_sizes(n, r)
            assert tr + va == n
            assert va == max(1, int(n * min(max(r, 0), 0.5)))


def test_offsets_and_tail_split(spark):
    lengths = [5, 0, 17, 3, 40, 1]
    st, flat = make_stream(spark, lengths)
    rows = sorted(st.collect(), key=lambda r: r.doc_id)
    offs = [r.start_off for r in rows]
    assert offs == [sum(lengths[:i]) for i in range(len(lengths))]
    total = S.total_tokens(st)
    assert total == len(flat)
    sp = S.split_tail(st, total, 0.2).collect()
    n_train, n_val, _ = S.split_sizes(total, 0.2)
    train = [x for r in sorted((r for r in sp if r.split == "train"), key=lambda r: r.start_off)
             for x in r.ids]
    val = [x for r in sorted((r for r in sp if r.split == "val"), key=lambda r: r.start_off)
           for x in r.ids]
    assert train == flat[:n_train] and val == flat[n_train:]


def test_windows_against_brute_force(spark):
    st, flat = make_stream(spark, [7, 30, 2, 51, 9, 16])
    n = len(flat)
    for b in (4, 16):
        blk = S.blocks(st, b)
        packed = {r.win_id: (r.x, r.y) for r in S.windows_packed(blk, b).collect()}
        assert len(packed) == S.window_count(n, b, b)
        for w, (x, y) in packed.items():
            assert x == flat[w * b:(w + 1) * b] and y == flat[w * b + 1:(w + 1) * b + 1]
        for stride in (1, 3):
            got = {r.win_id: (r.x, r.y) for r in S.windows_strided(blk, b, stride, n).collect()}
            exp = {i: (flat[i:i + b], flat[i + 1:i + b + 1]) for i in range(0, n - b, stride)}
            assert got == exp
            assert len(got) == S.window_count(n, b, stride)


def test_shuffle_is_partition_independent(spark):
    w = spark.range(0, 203).withColumnRenamed("id", "win_id")
    a = {r.win_id: (r.batch_id, r.row) for r in S.shuffled_batches(w, 8, 1337, 203).collect()}
    b = {r.win_id: (r.batch_id, r.row)
         for r in S.shuffled_batches(w.repartition(5), 8, 1337, 203).collect()}
    assert a == b
    assert len(a) == (203 // 8) * 8
    assert sorted(a.values()) == [(i // 8, i % 8) for i in range(len(a))]


def test_epochs_restart_and_drop_their_own_rest(spark):
    # 13 windows, 2 epochs, batches of 8: one whole batch each, 5 windows dropped each
    w = S.epochs(spark.range(13).withColumnRenamed("id", "win_id"), 2)
    rows = S.shuffled_batches(w, 8, 1337, 13, epoch="epoch").collect()
    assert sorted((r.epoch, r.batch_id, r.row) for r in rows) == [
        (e, e, i) for e in (0, 1) for i in range(8)]
    kept = {e: [r.win_id for r in sorted(rows, key=lambda r: r.row) if r.epoch == e] for e in (0, 1)}
    assert all(len(set(k)) == 8 for k in kept.values()) and kept[0] != kept[1]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 12, 13, 100, 1001])
def test_permutation_is_a_bijection(spark, n):
    ids = spark.range(n)
    got = [[r[0] for r in ids.select(S.permuted(F.col("id"), n, seed)).collect()] for seed in (7, 8)]
    assert all(sorted(g) == list(range(n)) for g in got)
    assert n < 12 or (got[0] != got[1] and got[0] != list(range(n)))


def test_shuffled_batches_move_no_rows(spark):
    w = S.epochs(spark.range(1000).withColumnRenamed("id", "win_id"), 2)
    plan = S.shuffled_batches(w, 8, 1, 1000, epoch="epoch")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_wide_rows_are_ordered_once(spark):
    rows = [(i, (i * 7919) % 1000, list(range(i % 5))) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, k long, ids array<int>").repartition(7)
    got = S.stream_offsets(df, ["k"])
    at, want = 0, {}
    for d, _, ids in sorted(rows, key=lambda r: r[1]):
        want[d], at = at, at + len(ids)
    assert {r.doc_id: r.start_off for r in got.collect()} == want and got.columns == [*df.columns, "start_off"]
    plan = got._jdf.queryExecution().executedPlan().toString()  # the parts' totals alone are shuffled
    assert "rangepartitioning" not in plan and plan.count("hashpartitioning(") == plan.count("hashpartitioning(_rp")


@pytest.mark.parametrize("vocab,width", [(1 << 16, 4), (65_535, 2)])
def test_packed_ids_round_trip(spark, vocab, width):
    rows = [(1, [0, 1, 255, 256, vocab - 1]), (2, []), (3, [vocab - 1] * 3)]
    df = spark.createDataFrame(rows, "k int, ids array<int>")
    assert P.id_bytes(vocab) == width
    p = df.withColumn("p", P.pack_ids(F.col("ids"), width)).withColumn("back", P.unpack_ids(F.col("p"), width))
    for r in p.collect():
        assert r.back == r.ids and bytes(r.p) == b"".join(i.to_bytes(width, "little") for i in r.ids)


def test_windows_by_position_open_few_files(spark, tmp_path):
    st, flat = make_stream(spark, [7, 30, 2, 51, 9, 16] * 20)
    out = str(tmp_path / "shards")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        P.write_packed_shards(st.withColumn("split", F.lit("train")), out, 70_000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    n, b = len(flat), 16
    index = P.shard_index(spark, out).collect()
    assert len(index) > 4
    for starts in ([0], [5, 6, 7], [n - b - 1], [n - b, n], list(range(n - b))):
        df = spark.createDataFrame([(s,) for s in starts], "start long")
        got, files = P.read_windows(spark, out, "train", df, b, 70_000)
        assert {r.start: (r.x, r.y) for r in got.collect()} == {
            s: (flat[s:s + b], flat[s + 1:s + b + 1]) for s in starts if s < n - b}
        assert len(files) <= 3 or len(starts) > 3
    assert P.window_starts(spark, n, b).count() == S.window_count(n, b)


def test_fim_unpermutes(spark):
    xs = [(i, list(range(20, 20 + n))) for i, n in enumerate([3, 5, 6, 7, 32, 32, 32, 32])]
    df = spark.createDataFrame(xs, "win_id long, x array<int>")
    got = fim_samples(df, 42, 4, 5, 6, 3, fim_rate=1.0).collect()
    for r in got:
        x = dict(xs)[r.win_id]
        s = r.input_ids + r.labels[-1:]
        if len(x) < 6:
            assert s == x
            continue
        assert len(s) == len(x) + 4 and s[-1] == 3
        if s[0] == 5:   # SPM: suffix, prefix, middle
            i4, i6 = s.index(4), s.index(6)
            suf, pre, mid = s[1:i4], s[i4 + 1:i6], s[i6 + 1:-1]
        else:           # PSM
            assert s[0] == 4
            i5, i6 = s.index(5), s.index(6)
            pre, suf, mid = s[1:i5], s[i5 + 1:i6], s[i6 + 1:-1]
        assert pre + mid + suf == x and pre and mid and suf
        assert r.labels == s[1:] and r.input_ids == s[:-1]


def test_collate_mixed_lengths_and_real_pad(spark):
    rows = [(0, 0, [1, 2, 3], [2, 3, 4]), (0, 1, [5, 1, 6, 7, 8, 9, 10], [1, 6, 7, 8, 9, 10, 11]),
            (0, 2, [1] * 7, [1] * 7), (0, 3, [9], [9])]
    df = spark.createDataFrame(rows, "batch_id long, row int, input_ids array<int>, labels array<int>")
    got = {r.row: r for r in collate(df, pad_id=1).collect()}
    assert got[0].input_ids == [1, 2, 3, 1, 1, 1, 1]
    assert got[0].labels == [2, 3, 4, -100, -100, -100, -100]
    assert got[0].attention_mask == [1, 1, 1, 0, 0, 0, 0]
    # pad id inside real text stays visible
    assert got[1].attention_mask == [1] * 7
    assert got[2].attention_mask == [1] * 7
    assert got[3].attention_mask == [1, 0, 0, 0, 0, 0, 0]


def test_blocks_are_cut_where_they_lie(spark):
    """No shuffle of whole blocks; any order of rows gives the same blocks."""
    import random
    rng = random.Random(4)
    ids = list(range(1000))
    rows, at = [], 0
    while at < len(ids):
        n = rng.choice([0, 1, 2, 5, 40])
        rows.append((at, ids[at:at + n]))
        at += n
    rng2 = random.Random(5)
    for shuffle in (False, True):
        if shuffle:
            rng2.shuffle(rows)
        st = spark.createDataFrame(rows, "start_off long, ids array<int>").repartition(1) if not shuffle \
            else spark.createDataFrame(rows, "start_off long, ids array<int>")
        for b, more in ((1, 1), (7, 0), (7, 1), (7, 7), (64, 3)):
            got = {r.blk: (r.at, r.ids, r.ahead) for r in S.blocks(st, b, ahead=more).collect()}
            assert got == {k: (k * b, ids[k * b:(k + 1) * b], ids[(k + 1) * b:(k + 1) * b + more])
                           for k in range(-(-1000 // b))}, (shuffle, b, more)
    plan = S.windows_packed(S.blocks(st, 7, ahead=1), 7)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
