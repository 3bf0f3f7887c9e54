"""Phrase collocation mining over count streams in prefix and suffix order.

Phrases of two and three words are scored by how often they occur against
their parts.  The layout is that of external stream estimation: counts of
one order are streams that name the streams of the order below, kept in
prefix order (a phrase beside what it begins with) and in suffix order (a
phrase beside what it ends with); streams of two orders are joined by
merging them in that order, which gives the counts of the left part, of the
right part and of the extensions.

1. Texts become integers, chunk by chunk: a task gathers words up to a bound,
   numbers those of the chunk, and writes the chunk's numbers and its word
   counts.  No count is final there; a chunk that ends inside a piece hands
   its last two words to the next one as context.
2. Words are counted over all chunks.  A phrase occurs at most as often as
   its parts, so words under ``min_count`` end a phrase, and their chunks
   need no name for them: nothing that could be a candidate is lost.
3. Each chunk meets the names of its own words and counts its pairs; pairs
   are counted over all chunks, and those that stay get a name.  The same
   step again gives the triples, each the names of its two pairs.
4. Merge joins.  Pairs in prefix order meet the words they begin with, in
   suffix order those they end with.  Triples in prefix order meet the pair
   they begin with (and through it the first word), in suffix order the pair
   they end with (and through it the last word).  A triple that has at least
   ``share`` percent of the occurrences of a pair inside it extends that pair:
   the pair is dropped.  A hot word or pair is one row on one side; adaptive
   execution splits the other.
5. Scores are exact integers (decimals of 38 digits: whole up to counts of
   10^16).  The best of a language are taken per slice first, so that a
   language with most of the candidates is no single task.

Defined cases: a null text is empty, a null language is ``und``; whole texts
are read whatever their length; repeated rows count each time; empty pieces
and empty tables give nothing; ties are broken as the order says; other
columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokloom.llm.common import BROADCAST_ROWS, documents, staged

MIN_COUNT, SHARE, TOP = 10, 50, 2000
#: Words of a chunk, and distinct words of a chunk, at most (about).
CHUNK_WORDS, CHUNK_NAMES = 1_500_000, 400_000
#: Bytes of a text that are split into words at a time.
SLICE_BYTES = 1 << 20
#: Pair names are three longs: so many rows are about 60 MB when broadcast.
BROADCAST_NAMES = 1_000_000
#: Slices of a language while its best phrases are found.
SLICES = 64

_BREAK = b".,;:!?\n\x0b\x0c\r"
#: Lower case, breaks as full stops, tabs as spaces.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else 46 if c in _BREAK else 32 if c == 9 else c
               for c in range(256))
_EDGE = re.compile(rb"[ .]")

CHUNK = "chunk long, local int, lang string, word string, n long, lead int, ids binary"


def word_runs(text: bytes, size: int = SLICE_BYTES):
    """Lists of words of a text, b"." for every break, some ``size`` bytes of
    text at a time."""
    text = text.translate(_PLAIN)
    low = 0
    while low < len(text):
        edge = _EDGE.search(text, low + size)
        high = edge.start() if edge and edge.start() > low else len(text)
        yield text[low:high].replace(b".", b" . ").split()
        low = high


class _Chunk:
    """Words gathered so far, numbered from 1; 0 is a break."""

    def __init__(self, context=()):
        self.tables, self.names, self.ids = {}, [], []
        for lang, word in context:
            self.ids.append(self.number(lang, word))
        self.lead = len(self.ids)

    def number(self, lang, word) -> int:
        table = self.tables.setdefault(lang, {b".": 0})
        at = table.get(word)
        if at is None:
            self.names.append((lang, word))
            at = table[word] = len(self.names)
        return at

    def add(self, lang, words):
        table = self.tables.setdefault(lang, {b".": 0})
        known, names, ids = table.get, self.names, self.ids
        for w in words:
            at = known(w)
            if at is None:
                names.append((lang, w))
                at = table[w] = len(names)
            ids.append(at)

    def full(self) -> bool:
        return len(self.ids) >= CHUNK_WORDS or len(self.names) >= CHUNK_NAMES

    def context(self):
        """The last two words, as far as no break follows them."""
        tail = self.ids[-2:]
        if 0 in tail:
            tail = tail[tail.index(0) + 1:] if tail[-1] else []
        return [self.names[i - 1] for i in tail]

    def batches(self, chunk: int):
        ids = np.array(self.ids, dtype=np.int32)
        count = np.bincount(ids[self.lead:], minlength=len(self.names) + 1)
        # frequent words get small numbers, which compress
        order = np.argsort(-count[1:], kind="stable")
        place = np.zeros(len(count), dtype=np.int32)
        place[order + 1] = np.arange(1, len(count), dtype=np.int32)
        m = len(order)
        for low in range(0, m, 10_000):
            part = order[low:low + 10_000]
            yield _rows(len(part), chunk, pa.array(np.arange(low + 1, low + len(part) + 1, dtype=np.int32)),
                        pa.array([self.names[i][0] for i in part], pa.string()),
                        pa.array([self.names[i][1] for i in part], pa.binary()).view(pa.string()),
                        pa.array(count[part + 1], pa.int64()), None, None)
        packed = pa.compress(place[ids].tobytes(), codec="zstd", asbytes=True)
        yield _rows(1, chunk, None, None, None, pa.array([len(ids)], pa.int64()),
                    pa.array([self.lead], pa.int32()), pa.array([packed], pa.binary()))


def _rows(n, chunk, *columns) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, chunk)), *[pa.nulls(n, k) if c is None else c for c, k in zip(columns, kinds)]],
        names=[x.split()[0] for x in CHUNK.split(", ")])


def _encode(batches):
    from pyspark import TaskContext
    number = TaskContext.get().partitionId() << 32
    held = _Chunk()
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, text in zip(batch.column("lang").to_pylist(), texts):
            for words in word_runs(text.as_py()):
                held.add(lang, words)
                if held.full():
                    yield from held.batches(number)
                    number += 1
                    held = _Chunk(held.context())
            held.ids.append(0)
    if len(held.ids) > held.lead:
        yield from held.batches(number)


def _decode(left: pa.Table) -> tuple[np.ndarray, int]:
    """The numbers of a chunk, and how many of them are context."""
    size = left.column("n")[0].as_py() * 4
    raw = pa.decompress(left.column("ids")[0].as_py(), size, codec="zstd", asbytes=True)
    return np.frombuffer(raw, dtype=np.int32).astype(np.int64), left.column("lead")[0].as_py()


def _longs(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


PAIRS = "chunk long, l1 int, l2 int, w1 long, w2 long, n long"


def _pairs(left: pa.Table, right: pa.Table) -> pa.Table:
    """Pairs of named words of one chunk with their counts; a pair of context
    words counts in the chunk before, here it only needs its name."""
    names = ("chunk", "l1", "l2", "w1", "w2", "n")
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    if not left.num_rows or not right.num_rows:
        return pa.table([pa.array([], k) for k in kinds], names=list(names))
    ids, lead = _decode(left)
    top = int(ids.max()) + 1
    wid = np.full(top, -1)
    wid[_longs(right, "local")] = _longs(right, "wid")
    known = wid[ids] >= 0
    both = known[:-1] & known[1:]
    every = ids[:-1] * top + ids[1:]
    code, n = np.unique(every[both], return_counts=True)
    if lead == 2 and len(both) and both[0]:
        n[np.searchsorted(code, every[0])] -= 1
    a, b = code // top, code % top
    chunk = np.full(len(code), left.column("chunk")[0].as_py())
    return pa.table([pa.array(x, k) for x, k in zip((chunk, a, b, wid[a], wid[b], n), kinds)],
                    names=list(names))


TRIPLES = "b12 long, b23 long, n long"


def _triples(left: pa.Table, right: pa.Table) -> pa.Table:
    """Triples of one chunk both of whose pairs have names."""
    if not left.num_rows or not right.num_rows:
        return pa.table([pa.array([], pa.int64())] * 3, names=["b12", "b23", "n"])
    ids, lead = _decode(left)
    top = int(ids.max()) + 1
    named = _longs(right, "l1") * top + _longs(right, "l2")
    order = np.argsort(named)
    named, bid = named[order], _longs(right, "bid")[order]
    code = ids[:-1] * top + ids[1:]
    at = np.minimum(np.searchsorted(named, code), len(named) - 1)
    hit = named[at] == code
    both = hit[:-1] & hit[1:]  # a triple ends after the context, which has two words at most
    found, n = np.unique(at[:-1][both] * len(named) + at[1:][both], return_counts=True)
    return pa.table([pa.array(x, pa.int64()) for x in (
        bid[found // len(named)], bid[found % len(named)], n)], names=["b12", "b23", "n"])


def _named(rows: DataFrame, names: DataFrame, on: list, most: int) -> DataFrame:
    return rows.join(F.broadcast(names) if names.count() <= most else names, on)


def counts(df: DataFrame, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged count streams of (lang, text): words (lang, word, n, wid), all of
    them; pairs (bid, w1, w2, n) and triples (b12, b23, n) from ``min_count``
    on."""
    rows = df.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    coded = staged(rows.mapInArrow(_encode, CHUNK), "chunks")
    chunks = coded.where("ids is not null").select("chunk", "n", "lead", "ids")
    local = coded.where("ids is null").select(F.col("chunk").alias("chunk"), "local", "lang", "word", "n")
    n_chunks = max(1, chunks.count())

    def by_chunk(f, names, schema):
        # as many partitions as chunks: a chunk is seconds of work in few bytes
        a, b = (x.repartition(n_chunks, "chunk").groupBy("chunk") for x in (chunks, names))
        return a.cogroup(b).applyInArrow(f, schema)

    words = staged(local.groupBy("lang", "word").agg(F.sum("n").alias("n"))
                   .withColumn("wid", F.monotonically_increasing_id()), "words")
    often = words.where(F.col("n") >= min_count).select("lang", "word", "wid")
    named = _named(local.select("chunk", "local", "lang", "word"), often, ["lang", "word"], BROADCAST_ROWS)
    held = staged(by_chunk(_pairs, named.select("chunk", "local", "wid"), PAIRS), "pairs")
    pairs = staged(held.groupBy("w1", "w2").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
                   .withColumn("bid", F.monotonically_increasing_id()), "pair-counts")
    named = _named(held.select("chunk", "l1", "l2", "w1", "w2"), pairs.select("w1", "w2", "bid"),
                   ["w1", "w2"], BROADCAST_NAMES)
    triples = by_chunk(_triples, named.select("chunk", "l1", "l2", "bid"), TRIPLES)
    return words, pairs, staged(triples.groupBy("b12", "b23").agg(F.sum("n").alias("n"))
                                .where(F.col("n") >= min_count), "triple-counts")


def _score(a: str, l: str, r: str) -> Column:
    a, l, r = (f"cast({x} as decimal(19,0))" for x in (a, l, r))
    return F.expr(f"({a} * {a} * cast(1000000 as decimal(7,0))) div ({l} * {r})")


def _merged(rows: DataFrame, other: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Two streams sorted by ``key`` and merged in lockstep."""
    return rows.join(other.hint("merge"), key, how)


def candidates(words: DataFrame, pairs: DataFrame, triples: DataFrame, share: int = SHARE) -> DataFrame:
    """lang, phrase, a, l, r, score of every candidate that no longer one
    replaces."""
    word = words.select(F.col("wid"), "lang", "word", F.col("n").alias("f"))
    two = _merged(pairs.withColumnRenamed("w1", "wid"), word.select(
        "wid", "lang", F.col("word").alias("s1"), F.col("f").alias("l")), "wid").drop("wid")
    two = _merged(two.withColumnRenamed("w2", "wid"), word.select(
        "wid", F.col("word").alias("s2"), F.col("f").alias("r")), "wid").drop("wid")
    two = staged(two.select("bid", "lang", "s1", "s2", F.col("n").alias("a"), "l", "r"), "pair-stream")
    prefix = two.select(F.col("bid").alias("b12"), "lang", F.concat_ws(" ", "s1", "s2").alias("head"),
                        F.col("l").alias("l1"), F.col("a").alias("l2"))
    suffix = two.select(F.col("bid").alias("b23"), F.col("s2").alias("last"),
                        F.col("a").alias("r1"), F.col("r").alias("r2"))
    three = staged(_merged(_merged(triples, prefix, "b12"), suffix, "b23"), "triple-stream")
    # a pair is replaced by four triples at most, whatever its own count
    gone = three.where(F.col("n") * 100 >= F.col("l2") * share).select(F.col("b12").alias("bid")).union(
        three.where(F.col("n") * 100 >= F.col("r1") * share).select(F.col("b23").alias("bid"))).distinct()
    two = _merged(two, gone, "bid", "left_anti").select(
        "lang", F.concat_ws(" ", "s1", "s2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    cuts = three.select("*", _score("n", "l1", "r1").alias("k1"), _score("n", "l2", "r2").alias("k2"))
    second = F.col("k2") < F.col("k1")
    three = cuts.select(
        "lang", F.concat_ws(" ", "head", "last").alias("phrase"), F.col("n").alias("a"),
        F.when(second, F.col("l2")).otherwise(F.col("l1")).alias("l"),
        F.when(second, F.col("r2")).otherwise(F.col("r1")).alias("r"),
        F.least("k1", "k2").alias("score"))
    return two.unionByName(three)


def collocations(df: DataFrame, min_count: int = MIN_COUNT, share: int = SHARE, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of every language of (lang, text): lang, rank,
    phrase, a, l, r, n, score."""
    words, pairs, triples = counts(df, min_count)
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    found = candidates(words, pairs, triples, share).withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
    found = found.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "slice").orderBy(*best))).where(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return found.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir, "lang", "text"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SQL = rf"""
WITH pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS t FROM (
       SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents)),
w AS (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS ws FROM pieces),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM (
        SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM w, (VALUES (1), (2), (3)) AS o(k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM g GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
cuts AS (SELECT lang, k, phrase, f, cut, array_to_string(string_split(phrase, ' ')[1:cut], ' ') AS lp,
                array_to_string(string_split(phrase, ' ')[cut + 1:k], ' ') AS rp
         FROM f, (VALUES (1), (2)) AS c(cut) WHERE f >= {MIN_COUNT} AND cut < k),
scored AS (SELECT c.lang, c.k, c.phrase, c.f AS a, c.cut, a.f AS l, b.f AS r, (1000000 * c.f * c.f) // (a.f * b.f) AS score
           FROM cuts c JOIN f a ON a.lang = c.lang AND a.phrase = c.lp AND a.k = c.cut
           JOIN f b ON b.lang = c.lang AND b.phrase = c.rp AND b.k = c.k - c.cut),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT lang, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '),
                                array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase, f
           FROM f WHERE k = 3 AND f >= {MIN_COUNT}),
kept AS (SELECT * FROM least s WHERE NOT EXISTS (
           SELECT 1 FROM inside i WHERE i.lang = s.lang AND i.phrase = s.phrase AND 100 * i.f >= {SHARE} * s.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}
"""
