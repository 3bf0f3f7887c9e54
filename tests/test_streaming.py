import os
import shutil
import tempfile

from pyspark.sql import functions as F

from tokloom.operators.corpus import take_until
from tokloom.plans.stream_ingest_queries import QUERIES, _stripped
from tokloom.streaming import ingest_available_now, streaming_counts


def split_files(spark, cuts):
    src = tempfile.mkdtemp(prefix="tokloom-src-")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for i, (lo, hi) in enumerate(cuts):
        tmp = f"{src}/_part{i}"
        docs.where(f"doc_id >= {lo} and doc_id < {hi}").coalesce(1).write.parquet(tmp)
        for f in os.listdir(tmp):
            if f.endswith(".parquet"):
                shutil.copy(f"{tmp}/{f}", f"{src}/f{i}.parquet")
    return src, docs


def test_multi_epoch_ingest_equals_batch(spark):
    src, docs = split_files(spark, [(0, 70), (70, 140), (140, 10**9)])
    batch = take_until(_stripped(docs), ["doc_id"], "n_bytes", 4, 20000, group=["source"])
    exp = sorted(r.doc_id for r in batch.collect())
    path = ingest_available_now(spark, src, docs.schema, _stripped, order=["doc_id"],
                                size_col="n_bytes", group=["source"], max_files=4,
                                max_bytes=20000, glob="f*.parquet")
    got = spark.read.parquet(path)
    assert sorted(r.doc_id for r in got.collect()) == exp
    assert got.select("epoch").distinct().count() >= 2
    cpath = streaming_counts(spark, src, docs.schema, _stripped, ["lang"], "n_bytes",
                             glob="f*.parquet")
    counts = {r.lang: r.n_rows for r in spark.read.parquet(cpath).collect()}
    exp_counts = {r.lang: r["count"] for r in _stripped(docs).groupBy("lang").count().collect()}
    assert counts == exp_counts


def test_quota_is_by_arrival(spark):
    # files arrive with their id ranges in reverse
    src, docs = split_files(spark, [(140, 10**9), (70, 140), (0, 70)])
    for i in range(3):
        os.utime(f"{src}/f{i}.parquet", (1_000_000 + i, 1_000_000 + i))
    place = F.when(F.col("doc_id") >= 140, 0).when(F.col("doc_id") >= 70, 1).otherwise(2)
    batch = take_until(_stripped(docs).withColumn("_place", place), ["_place", "doc_id"], "n_bytes",
                       4, None, group=["source"])
    path = ingest_available_now(spark, src, docs.schema, _stripped, order=["doc_id"],
                                size_col="n_bytes", group=["source"], max_files=4, glob="f*.parquet")
    got = sorted(r.doc_id for r in spark.read.parquet(path).collect())
    assert got == sorted(r.doc_id for r in batch.collect())


def test_state_of_many_epochs_is_one_snapshot(spark):
    src, docs = split_files(spark, [(i * 20, (i + 1) * 20) for i in range(9)])
    batch = take_until(_stripped(docs.where("doc_id < 180")), ["doc_id"], "n_bytes", 20, None, group=["source"])
    path = ingest_available_now(spark, src, docs.schema, _stripped, order=["doc_id"],
                                size_col="n_bytes", group=["source"], max_files=20, glob="f*.parquet")
    got = spark.read.parquet(path)
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in batch.collect())
    state = os.path.dirname(path.removeprefix("file:")) + "/state"
    assert sorted(os.listdir(state)) == ["epoch=7", "epoch=8"]
    sums = spark.read.parquet(f"{state}/epoch=8").agg(F.sum("n_rows").alias("n")).first().n
    assert sums == got.count()


def test_ingest_queries_read_a_folder_of_files(spark):
    """The documents table as a folder of several files, ids dealt over them."""
    sf = tempfile.mkdtemp(prefix="tokloom-sf-")
    rows = [(i, "ab" * (i % 5), "en" if i % 3 else None, f"s{i % 2}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.repartition(5, "doc_id").write.parquet(f"{sf}/documents.parquet")
    kept = _stripped(docs)
    batch = take_until(kept, ["doc_id"], "n_bytes", 30, None, group=["source"])
    got = QUERIES["ingest_available_now"](spark, sf)
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in batch.collect())
    counts = {r.lang: r.n_rows for r in QUERIES["ingest_counts"](spark, sf).collect()}
    assert counts == {r.lang: r["count"] for r in kept.groupBy("lang").count().collect()}
