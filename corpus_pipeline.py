"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  Stages are meant to be written as
Parquet one by one; ``run`` does that in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokloom.llm.common import documents, staged
from tokloom.llm.line_dedup import delete_runs
from tokloom.llm.mixing import emit_mix
from tokloom.llm.ngram_join import keep_one
from tokloom.llm.packing import pack
from tokloom.llm.toxicity import reject_toxic, train_side


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return reject_toxic(docs, train_side(docs, labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of runs of 50 words or more are cut from the texts;
    documents stay, also those whose text becomes empty."""
    cut = delete_runs(docs)
    return cut.withColumn("n_chars", F.when(F.col("__n_removed") > 0, F.length("text").cast("long"))
                          .otherwise(F.col("n_chars"))).select(*docs.columns)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the
    smallest id; near-duplicates share 80 % of their five-word shingles."""
    return keep_one(docs, n=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return emit_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and their places in sequences of 1024 tokens."""
    return pack(docs, added_tokens=True)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("ngram_join", ngram_join),
          ("mixing", mixing), ("packing", packing)]

#: The trained classifier and the tokenizer cannot be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
