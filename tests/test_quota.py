from pyspark.sql import functions as F

from tokloom.operators.corpus import strip_nonempty, take_until
from tokloom.operators.ordered import running_sums


def reference_quota(lengths, max_files, max_bytes):
    """Plain loop: write, then stop once a limit is reached."""
    kept, count, written = [], 0, 0
    for i, n in enumerate(lengths):
        if n == 0:
            continue
        kept.append(i)
        count += 1
        written += n
        if max_files and count >= max_files:
            break
        if max_bytes and written >= max_bytes:
            break
    return kept


def test_quota_limits(spark):
    lengths = [10, 10, 10, 0, 10]
    rows = [("ds1", i, "x" * n) for i, n in enumerate(lengths)] + \
           [("ds2", i, "y" * n) for i, n in enumerate(lengths)]
    df = spark.createDataFrame(rows, "dataset string, idx int, text string")
    df = strip_nonempty(df).withColumn("n", F.length("text"))
    for mf, mb in [(None, 25), (2, None), (2, 25), (None, None), (0, 0)]:
        got = take_until(df, ["idx"], "n", mf, mb, group=["dataset"]).collect()
        exp = reference_quota(lengths, mf, mb)
        for ds in ("ds1", "ds2"):
            assert sorted(r.idx for r in got if r.dataset == ds) == exp, (mf, mb)


def test_running_sums_match_single_window(spark):
    import random
    rnd = random.Random(3)
    # one hot group holding most rows
    rows = [("hot" if rnd.random() < 0.6 else f"g{rnd.randrange(20)}", i, rnd.randrange(100))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, k int, v int")
    got = running_sums(df, ["k"], {"s": F.col("v").cast("long")}, group=["g"], parts=7).collect()
    acc, exp = {}, {}
    for g, k, v in sorted(rows, key=lambda r: r[1]):
        exp[(g, k)] = acc.get(g, 0)
        acc[g] = acc.get(g, 0) + v
    assert {(r.g, r.k): r.s for r in got} == exp


def test_quota_stops_opening_files(spark, tmp_path):
    from tokloom.operators.corpus import take_until_files
    out = str(tmp_path / "files")
    spark.range(0, 1600).select(F.col("id").alias("k"), F.lit(10).cast("long").alias("n")) \
        .repartitionByRange(16, "k").write.parquet(out)
    back = spark.read.parquet(out)
    files = sorted(back.inputFiles())
    assert len(files) > 12
    for most, opened in ((500, 1), (2990, 4), (None, len(files))):
        got, n = take_until_files(spark, files, back.schema, lambda df: df, ["k"], "n", None, most)
        assert sorted(r.k for r in got.collect()) == list(range(most // 10 if most else 1600))
        assert n == opened
