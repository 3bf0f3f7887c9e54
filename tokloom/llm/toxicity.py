"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positive class; a sample of all documents,
whatever their labels, stands for the unlabelled mixture.  A linear model
over words and word beginnings is fitted by the class-prior-corrected risk

    prior * R+(toxic) + max(0, R-(unlabelled) - prior * R-(toxic))

with the sigmoid loss; when a batch's negative part falls below zero the
step ascends it instead.  The prior is the toxic share of the labelled
training rows.  Fitting is numpy on the driver over a bounded sample (the
three SAMPLE/FEATURES parameters); scoring is one pass over all documents
with the weights (at most FEATURES of them) broadcast, and shuffles nothing.

Only features that are at least twice as frequent among the positives as in
the mixture take part, so a long clean text does not drown a short insult.

Defined cases: a null or empty text has no features and scores the bias; a
null id counts as the empty text where rows are held out; several labels of
one document count as toxic if any says so, null labels are ignored; without
a confirmed toxic document every score is 0; an empty table gives no rows;
other columns are never read, and ``reject_toxic`` carries all of them on.
"""

from __future__ import annotations

import string
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokloom.llm.common import KNOWN_WORDS, documents, give_back, id_crc32, one_by_one, row_key, staged

#: Bounds of the fitting sample, in documents, and of the model, in weights.
SAMPLE_TOXIC = 4000
SAMPLE_UNLABELLED = 12000
FEATURES = 5000
MIN_TOXIC_DOCS = 3
BEGINNINGS = (4, 5, 6)


def word_features(word: str) -> list[str]:
    """The bare word and its beginnings."""
    w = word.strip(string.punctuation)
    return [w, *(w[:k] + "*" for k in BEGINNINGS if len(w) > k)] if w else []


def text_features(text: str) -> set[str]:
    return {f for w in set(text.lower().split()) for f in word_features(w)}


def held_out(doc_id: Column, fold: int = 5) -> Column:
    return id_crc32(doc_id) % fold == 0


@dataclass(frozen=True)
class ToxicModel:
    weights: dict  # feature -> weight
    bias: float

    def scorer(self):
        """text -> score; words met before are looked up in a bounded table."""
        weights, bias, known = self.weights, self.bias, {}

        def score(text: str) -> float:
            hits = set()
            for w in set(text.lower().split()):
                f = known.get(w)
                if f is None:
                    if len(known) > KNOWN_WORDS:
                        known.clear()
                    f = known[w] = tuple(x for x in word_features(w) if x in weights)
                if f:
                    hits.update(f)
            z = bias + sum(weights[x] for x in sorted(hits))
            return 1.0 / (1.0 + np.exp(-z)) if z > -700 else 0.0

        return score


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0)))


class _Rows:
    """Sparse binary rows."""

    def __init__(self, rows: list[np.ndarray], dim: int):
        self.n, self.dim = len(rows), dim
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.col = np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64)

    def z(self, w, b):
        return np.bincount(self.row, w[self.col], self.n) + b

    def back(self, g):
        return np.append(np.bincount(self.col, g[self.row], self.dim), g.sum())


def fit_nnpu(toxic: list, unlabelled: list, prior: float, dim: int, epochs: int = 60,
             batches: int = 8, rate: float = 0.05, decay: float = 1e-4, seed: int = 0):
    """(weights, bias) minimising the non-negative risk by Adam."""
    rng = np.random.default_rng(seed)
    theta = np.append(np.zeros(dim), -2.0)
    m1, m2, t = np.zeros(dim + 1), np.zeros(dim + 1), 0
    for _ in range(epochs):
        order_p, order_u = rng.permutation(len(toxic)), rng.permutation(len(unlabelled))
        for bp, bu in zip(np.array_split(order_p, batches), np.array_split(order_u, batches)):
            if not len(bp) or not len(bu):
                continue
            p = _Rows([toxic[i] for i in bp], dim)
            u = _Rows([unlabelled[i] for i in bu], dim)
            sp, su = _sigmoid(p.z(theta[:-1], theta[-1])), _sigmoid(u.z(theta[:-1], theta[-1]))
            gp, gu = sp * (1 - sp) / p.n, su * (1 - su) / u.n
            if su.mean() - prior * sp.mean() >= 0:
                grad = p.back(-2 * prior * gp) + u.back(gu)
            else:
                grad = p.back(prior * gp) - u.back(gu)
            grad[:-1] += decay * theta[:-1]
            t += 1
            m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad * grad
            theta = theta - rate * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.999 ** t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def _sample(docs: DataFrame, toxic_ids: DataFrame, n_docs: int, unlabelled: int) -> DataFrame:
    """Texts of the fitting sample, flagged p (confirmed) and u (mixture)."""
    key = row_key(F.col("doc_id"), F.col("text"))
    u = F.conv(F.substring(key, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
    marked = docs.join(F.broadcast(toxic_ids.withColumn("p", F.lit(True))), "doc_id", "left")
    return (marked.select(key.alias("key"), F.coalesce("text", F.lit("")).alias("text"),
                          F.coalesce("p", F.lit(False)).alias("p"),
                          (u < unlabelled / max(n_docs, 1)).alias("u"))
            .where("p or u"))


def train_toxicity(docs: DataFrame, labels: DataFrame, sample_toxic: int = SAMPLE_TOXIC,
                   sample_unlabelled: int = SAMPLE_UNLABELLED,
                   features: int = FEATURES) -> ToxicModel:
    """Fit on the given training rows: docs (doc_id, text), labels (doc_id,
    toxic)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    n = marks.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    if not n["toxic"]:
        return ToxicModel({}, -800.0)
    prior = n["toxic"] / n["n"]
    share = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast(
        "long") / F.lit(4294967296.0)
    # about sample_toxic rows, whatever the number of labels
    chosen = marks.where((F.col("toxic") == 1) & (share < sample_toxic / n["toxic"])).select("doc_id")
    sample = staged(_sample(docs, chosen, docs.select("doc_id").count(), sample_unlabelled), "toxic")

    def count(batches):
        for batch in batches:
            p, u = Counter(), Counter()
            for text, is_p, is_u in zip(*(one_by_one(batch.column(c)) for c in ("text", "p", "u"))):
                found = text_features(text)
                if is_p:
                    p.update(found)
                if is_u:
                    u.update(found)
            names = list(p.keys() | u.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([p[f] for f in names], pa.int64()),
                 pa.array([u[f] for f in names], pa.int64())], names=["f", "p", "u"])

    size = sample.agg(F.sum(F.col("p").cast("long")).alias("p"),
                      F.sum(F.col("u").cast("long")).alias("u")).first()
    if not size["p"]:
        return ToxicModel({}, -800.0)
    a = F.col("p") / F.lit(float(size["p"]))
    b = F.greatest(F.col("u") / F.lit(float(size["u"] or 1)), prior * a)
    top = (sample.mapInArrow(count, "f string, p long, u long").groupBy("f")
           .agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
           .where(F.col("p") >= MIN_TOXIC_DOCS)
           .select("f", ((a - b) * (a - b) / b).alias("gain"), (a / b).alias("ratio"))
           .where("ratio >= 2").orderBy(F.desc("gain"), "f").limit(features).collect())
    names = [r["f"] for r in top]
    place = spark.sparkContext.broadcast({f: i for i, f in enumerate(names)})

    def index(batches):
        at = place.value
        for batch in batches:
            rows = [np.array(sorted(at[f] for f in text_features(t) if f in at), np.int32).tobytes()
                    for t in one_by_one(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("p"), batch.column("u"),
                 pa.array(rows, pa.binary())], names=["key", "p", "u", "idx"])

    # bounded: the sample's rows, with places of chosen features only
    rows = sorted(sample.mapInArrow(index, "key string, p boolean, u boolean, idx binary").collect(),
                  key=lambda r: (r["key"], r["p"], r["u"]))
    toxic = [np.frombuffer(r["idx"], np.int32) for r in rows if r["p"]]
    mixed = [np.frombuffer(r["idx"], np.int32) for r in rows if r["u"]]
    w, bias = fit_nnpu(toxic, mixed, prior, len(names))
    return ToxicModel({f: float(x) for f, x in zip(names, w)}, bias)


def score_toxicity(df: DataFrame, model: ToxicModel) -> DataFrame:
    """doc_id, score of every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        one = shared.value.scorer()
        for batch in batches:
            got = [one(t or "") for t in one_by_one(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())],
                                             names=["doc_id", "score"])
        del one
        give_back()

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        score, "doc_id long, score double")


def reject_toxic(df: DataFrame, model: ToxicModel, threshold: float = 0.5) -> DataFrame:
    """The rows of ``df``, all columns as they are, that score below the
    threshold."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index("text")

    def keep(batches):
        one = shared.value.scorer()
        for batch in batches:
            mask = [one(t or "") < threshold for t in one_by_one(batch.column(at))]
            yield batch.filter(pa.array(mask, pa.bool_()))
        del one
        give_back()

    return df.mapInArrow(keep, df.schema)


def train_side(docs: DataFrame, labels: DataFrame) -> ToxicModel:
    """Fit on the rows that are not held out."""
    side = ~held_out(F.col("doc_id"))
    return train_toxicity(docs.where(side), labels.where(side))


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = score_toxicity(docs, train_side(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
