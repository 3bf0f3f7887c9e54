"""Ranked lexical search: MaxScore with bounds of term pairs.

A batch of queries is answered against all documents at once.  A document's
score is a sum of impacts, one for each query term it holds; the documents
with the highest sums are wanted, so a document (or a run of documents) whose
bound stays under the lowest score still of use is never summed up.

1. One pass over the texts keeps, of each document, its length and the
   occurrences of the batch's terms.  Document count, total length and
   document frequencies are sums of one row per task and term.
2. Shards of documents, ordered by length and cut into short runs, become an
   index: a posting list per term with impacts, and for every chosen pair of
   terms its intersection with the joint maximum impact of each run.  Either
   the two terms meet in a document of the run, then the joint maximum bounds
   both, or they do not, then the larger of the two maxima does: in both
   cases less than the sum of the two maxima, which is all that bounds of
   single terms know.  Each query's terms are paired off by neighbouring
   document frequency (an odd one stays single); pairs are shared by queries.
3. A query adds the bounds of its pairs per run and skips the runs that stay
   under its threshold.  In what is left, pairs are ordered by their bounds:
   those whose bounds together stay under the threshold find no documents of
   their own, they are only looked up for documents that the others found,
   and only as long as score so far and bounds to come reach the threshold.
4. The threshold of a query starts at the ``top``-th best score of a hash
   sample of the documents (1 in SAMPLE, growing with the table): these are
   scores of documents of the table, so nothing better is lost.  A task
   raises it as it finds better ones, and hands on ``top`` rows a query.

The queries of a batch are bounded (BATCH_ITEMS, about); more of them are
several batches over the same documents.

Defined cases: null texts have no terms and are counted in nothing; whole
texts are read; repeated rows are documents of their own, each with its rank;
rows without id come after those with one at equal scores; repeated queries
(same id and text) are one; a query without terms has no rows; empty tables
give none; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokloom.llm.common import documents, staged

TOP = 50
#: Queries of a batch, about (they are dealt to batches by hash).
BATCH_ITEMS = 500
#: One document in so many gives the first thresholds.
SAMPLE = 64
#: Documents of a shard, and of a run inside it.
SHARD_DOCS, RUN_DOCS = 4096, 64

#: ASCII letters as lower case, digits and everything beyond ASCII as they
#: are, the rest blank.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


COUNTS = "doc_id long, n long, terms array<int>, tfs array<int>, stat int, amount long"
#: Numbers of the two totals among the rows of document frequencies.
N_DOCS, N_TERMS = -1, -2


def _count(batches, vocabulary: dict):
    """A row per document with its batch terms, and at the end of a task a row
    per term with its documents there."""
    df = np.zeros(len(vocabulary), dtype=np.int64)
    docs = words = 0
    get = vocabulary.get
    names = [x.split()[0] for x in COUNTS.split(", ")]
    for batch in batches:
        kept, length, held, tfs = [], [], [], []
        ids = batch.column("doc_id")
        for i, text in enumerate(batch.column("text").cast(pa.binary())):
            ws = terms(text.as_py() or b"")
            if not ws:
                continue
            docs, words = docs + 1, words + len(ws)
            found = [t for t in map(get, ws) if t is not None]
            if not found:
                continue
            t, tf = np.unique(np.array(found, dtype=np.int32), return_counts=True)
            df[t] += 1
            kept.append(i)
            length.append(len(ws))
            held.append(t)
            tfs.append(tf.astype(np.int32))
        m = len(kept)
        ends = np.concatenate([[0], np.cumsum([len(x) for x in held])]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(ends, np.concatenate(x) if x else np.zeros(0, np.int32))
                 for x in (held, tfs)]
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(kept, pa.int64())), pa.array(length, pa.int64()), *lists,
             pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64())], names=names)
    seen = np.flatnonzero(df)
    stat = np.concatenate([seen, [N_DOCS, N_TERMS]])
    amount = np.concatenate([df[seen], [docs, words]])
    m = len(stat)
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.list_(pa.int32())),
         pa.nulls(m, pa.list_(pa.int32())), pa.array(stat, pa.int32()), pa.array(amount, pa.int64())], names=names)


class Batch:
    """Queries, weights and pairs of one batch."""

    def __init__(self, items: list[tuple], stats: dict, vocabulary: dict):
        self.n_docs, self.n_terms = stats.get(N_DOCS, 0), stats.get(N_TERMS, 0)
        self.weight = np.zeros(len(vocabulary), dtype=np.int64)
        for t, df in stats.items():
            if t >= 0:
                self.weight[t] = math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * df + 1)))
        self.items, self.pairs, known = [], [], {}
        for item_id, text in items:
            own = {vocabulary[w] for w in terms((text or "").encode("utf-8", "surrogatepass"))}
            own = sorted((t for t in own if stats.get(t)), key=lambda t: (-stats[t], t))
            units = []
            for i in range(0, len(own), 2):
                pair = tuple(own[i:i + 2])
                if pair not in known:
                    known[pair] = len(self.pairs)
                    self.pairs.append(pair)
                units.append(known[pair])
            self.items.append((item_id, np.array(units, dtype=np.int64)))

    def norm(self, n: np.ndarray) -> np.ndarray:
        """The length factor m of documents of n terms."""
        if len(n) and int(n.max()) * 50 * self.n_docs >= 1 << 63:  # beyond 64 bits: whole numbers of Python
            return np.array([50 + 50 * int(x) * self.n_docs // self.n_terms for x in n], dtype=np.int64)
        return 50 + (50 * n * self.n_docs) // self.n_terms


class Shard:
    """Posting lists and joint maxima of some documents."""

    def __init__(self, batch: Batch, n: np.ndarray, term: np.ndarray, tf: np.ndarray, ends: np.ndarray):
        order = np.argsort(n, kind="stable")
        self.order, m = order, len(n)
        place = np.empty(m, dtype=np.int64)
        place[order] = np.arange(m)
        doc = place[np.repeat(np.arange(m), np.diff(ends))]
        by_term = np.lexsort((doc, term))
        term, doc, tf = term[by_term], doc[by_term], tf[by_term].astype(np.int64)
        m_doc = batch.norm(n[order])[doc]
        self.doc = doc
        self.impact = batch.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m_doc))
        self.low = np.searchsorted(term, np.arange(len(batch.weight) + 1))
        self.size = m
        self.starts = np.arange(0, m, RUN_DOCS)
        self.run = np.arange(m) // RUN_DOCS
        self.batch = batch
        self.joint = np.zeros((len(batch.pairs), len(self.starts)), dtype=np.int64)
        for p, pair in enumerate(batch.pairs):
            both = np.zeros(m, dtype=np.int64)
            for t in pair:
                docs, impacts = self.postings(t)
                both[docs] += impacts
            self.joint[p] = np.maximum.reduceat(both, self.starts)

    def postings(self, t: int):
        a, b = self.low[t], self.low[t + 1]
        return self.doc[a:b], self.impact[a:b]

    def search(self, units: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of all that score ``least`` or more."""
        bounds = self.joint[units]
        alive = bounds.sum(axis=0) >= least
        if not alive.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        top = bounds[:, alive].max(axis=1)
        order = np.argsort(top, kind="stable")
        finds = int(np.searchsorted(np.cumsum(top[order]), least))  # from here on units find documents
        score = np.zeros(self.size, dtype=np.int64)
        for u in order[finds:]:
            for t in self.batch.pairs[units[u]]:
                docs, impacts = self.postings(t)
                score[docs] += impacts
        rest = bounds[order[:finds]].sum(axis=0)
        found = np.flatnonzero((score > 0) & alive[self.run] & (score + rest[self.run] >= least))
        score = score[found]
        for u in order[:finds][::-1]:
            if not len(found):
                break
            for t in self.batch.pairs[units[u]]:
                docs, impacts = self.postings(t)
                if len(docs):
                    at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                    score = score + np.where(docs[at] == found, impacts[at], 0)
            rest = rest - bounds[u]
            keep = score + rest[self.run[found]] >= least
            found, score = found[keep], score[keep]
        return self.order[found], score


HITS = "item int, doc_id long, score long"


def _search(batches, batch: Batch, least: np.ndarray, top: int):
    """The best documents of a task for every query."""
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in batch.items]
    least = least.copy()
    for rows in batches:
        for low in range(0, rows.num_rows, SHARD_DOCS):
            part = rows.slice(low, SHARD_DOCS)
            lists = part.column("terms")
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            ids = part.column("doc_id")
            none = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            shard = Shard(batch, part.column("n").to_numpy(), lists.flatten().to_numpy(),
                          part.column("tfs").flatten().to_numpy(), ends)
            for q, (_, units) in enumerate(batch.items):
                if not len(units):
                    continue
                found, score = shard.search(units, int(least[q]))
                if not len(found):
                    continue
                s, d, x = (np.concatenate(c) for c in zip(best[q], (score, ids[found], none[found])))
                order = np.lexsort((d, x, -s))[:top]
                best[q] = s[order], d[order], x[order]
                if len(order) == top:
                    least[q] = max(least[q], s[order[-1]])
    item = np.repeat(np.arange(len(best)), [len(b[0]) for b in best])
    s, d, x = (np.concatenate(c) if best else np.zeros(0, np.int64) for c in zip(*best)) if best else [np.zeros(0)] * 3
    yield pa.RecordBatch.from_arrays(
        [pa.array(item, pa.int32()), pa.array(d.astype(np.int64), pa.int64(), mask=x.astype(bool)),
         pa.array(s.astype(np.int64), pa.int64())], names=["item", "doc_id", "score"])


def _ranked(hits: DataFrame) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(w))


def _search_batch(docs: DataFrame, items: list[tuple], top: int) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    vocabulary: dict = {}
    for _, text in items:
        for w in terms((text or "").encode("utf-8", "surrogatepass")):
            vocabulary.setdefault(w, len(vocabulary))
    shared = sc.broadcast(vocabulary)
    counted = staged(docs.mapInArrow(lambda b: _count(b, shared.value), COUNTS), "counts")
    stats = {r.stat: r.amount for r in counted.where("stat is not null").groupBy("stat").agg(
        F.sum("amount").alias("amount")).collect()}  # a row per term of the batch
    batch = sc.broadcast(Batch(items, stats, vocabulary))
    rows = counted.where("stat is null").select("doc_id", "n", "terms", "tfs")

    def run(rows, least):
        return rows.mapInArrow(lambda b: _search(b, batch.value, least, top), HITS)

    least = np.ones(len(items), dtype=np.int64)
    sample = rows.where(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(SAMPLE)) == 0)
    for r in _ranked(run(sample, least)).where(F.col("rank") == top).collect():  # a row per query
        least[r.item] = r.score
    first = least
    names = docs.sparkSession.createDataFrame(
        [(q, item_id) for q, (item_id, _) in enumerate(items)], "item int, item_id long")
    hits = _ranked(run(rows, first)).where(F.col("rank") <= top)
    return hits.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents (doc_id, text)
    of each query (item_id, text) with a score above 0."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    n_batches = max(1, -(-items.count() // BATCH_ITEMS))
    dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_batches))
    out = None
    for i in range(n_batches):
        own = sorted(((r.item_id, r.text) for r in items.where(dealt == i).collect()),
                     key=lambda x: (x[0] is None, x[0] or 0, x[1] or ""))
        found = _search_batch(docs, own, top)
        found = staged(found, "hits") if n_batches > 1 else found
        out = found if out is None else out.unionByName(found)
    return out


def op12_search(spark, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir, "doc_id", "text"),
                  spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = (rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS ts FROM documents),
stats AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
tf AS (SELECT rid, t, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(ts) AS t FROM d) GROUP BY rid, t),
q AS (SELECT DISTINCT item_id, text, unnest({_TERMS}) AS t FROM benchmark),
df AS (SELECT t, count(*)::BIGINT AS df FROM tf WHERE t IN (SELECT t FROM q) GROUP BY t),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, stats),
m AS (SELECT rid, doc_id, 50 + (50 * len(ts)::BIGINT * n_docs) // n_terms AS m FROM d, stats),
i AS (SELECT rid, doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS impact
      FROM tf JOIN w USING (t) JOIN m USING (rid)),
s AS (SELECT item_id, text, rid, doc_id, sum(impact)::BIGINT AS score FROM q JOIN i USING (t) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank,
       doc_id, score
FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) <= {TOP}
"""
