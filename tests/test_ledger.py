import os

from pyspark.sql import functions as F

from tokloom.session import remove_tree
from tokloom.sources.ledger import is_done, retain, run_stage, stage_path, table_digest


def test_digest_follows_rows_not_their_order(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k int, t string")
    same = spark.createDataFrame([(2, None), (1, "a"), (2, None)], "k int, t string").repartition(3)
    assert table_digest(df) == table_digest(same)
    for other in (df.distinct(), df.union(df), df.withColumn("k", F.col("k") + 1), df.withColumnRenamed("t", "u"),
                  df.withColumn("t", F.coalesce("t", F.lit("")))):
        assert table_digest(other) != table_digest(df)


def test_stage_runs_once_for_the_same_inputs_and_parameters(spark, tmp_path):
    df = spark.range(5)
    built = []

    def build(path):
        built.append(path)
        df.write.parquet(path)

    root = str(tmp_path)
    first = run_stage(spark, "copy", [df], {"n": 1}, build, root)
    assert run_stage(spark, "copy", [spark.range(5)], {"n": 1}, build, root) == first and len(built) == 1
    assert run_stage(spark, "copy", [df], {"n": 2}, build, root) != first
    assert run_stage(spark, "copy", [spark.range(6)], {"n": 1}, build, root) != first and len(built) == 3


def test_a_stage_that_died_runs_anew(spark, tmp_path):
    df = spark.range(3)
    path = stage_path(spark, "s", [table_digest(df)], {}, str(tmp_path))

    def dies(data):
        df.write.parquet(data)
        raise RuntimeError("lost")

    try:
        run_stage(spark, "s", [df], {}, dies, str(tmp_path))
    except RuntimeError:
        pass
    assert os.path.isdir(f"{path}/data") and not is_done(spark, path)
    assert spark.read.parquet(run_stage(spark, "s", [df], {}, lambda d: df.write.parquet(d), str(tmp_path))).count() == 3
    assert is_done(spark, path)


def test_retention_removes_what_is_not_kept(spark, tmp_path):
    paths = [str(tmp_path / f"run{i}") for i in range(4)]
    for p in paths:
        spark.range(1).write.parquet(p)
    every = spark.createDataFrame([(p,) for p in paths], "path string")
    assert retain(spark, every, every.where(F.col("path") >= paths[2])) == 2
    assert [os.path.isdir(p) for p in paths] == [False, False, True, True]
    remove_tree(spark, paths[0])  # an absent folder is no error


def test_learning_leaves_no_round_tables(spark):
    from tokloom.operators.bpe import learn_vocab
    from tokloom.session import checkpoint_dir
    root = checkpoint_dir(spark).removeprefix("file:")
    docs = spark.createDataFrame([("the theme then there " * 3,)] * 3, "text string")
    learn_vocab(docs, 15 + 256 + 8, ahead_symbols=10)
    assert not [d for d in os.listdir(root) if d.startswith("bpe-")]
