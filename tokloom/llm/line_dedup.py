"""Line dedup by winnowing over line hashes.

Passages repeat wherever they like: across the lines of one text and inside
longer lines of another.  So texts are wrapped anew: at every word a line of
LINE_WORDS words begins, whatever white space lies between.  A word goes when
it stands in a run of ``min_words`` words that also stands at an earlier
place: in a document with a smaller id, or further up in the same one and not
overlapping.  With a word goes the white space after it.  Whatever is deleted
stays at an earlier place.

1. Lines are hashed.  Of the lines inside each run of ``min_words`` words the
   one with the smallest hash is the run's fingerprint.  Equal runs choose
   equal fingerprints, so any two places that share a run share one; they are
   few, as neighbouring runs mostly agree on theirs.
2. A text that as a whole stands in another document is one long run: all
   but its first copy become empty, and only that one goes on.
3. Fingerprints are counted (combined before the shuffle); only texts with
   one that occurs twice go on.
4. Their matches are extended both ways, word by word: every run whose
   fingerprint occurs twice is named by 128 bits.  Runs meet by name, an
   aggregate finds the first place of each, and every later place is
   deleted.  Matches that are longer are chains of such runs, so their union
   is the whole match; no pair of documents is ever listed, and a run that a
   third of all documents share costs one row for each.
5. Texts of the documents concerned are rewritten; the others pass as they
   are and their texts are not shuffled.

Work is linear in the words of a text: hashes of lines and runs are
differences of running sums, minima are taken over 26 lines each.

Defined cases: a null text stays null, an empty one stays empty; documents
without ids come last, in order of their content; repeated rows (same id and
text) count as one place and are edited alike; a text all of whose words go
keeps only the white space before the first, its row stays; a run that
overlaps its own first place stays; a text of 2^29 words or more is an error
(its string is beyond 1 GB); an empty table gives no rows;
``delete_runs`` carries other columns along whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokloom.llm.common import (BROADCAST_ROWS, documents, give_back, join_by_size, one_by_one,
                                row_key, staged)
from tokloom.operators.ordered import running_sums

MIN_WORDS = 50
LINE_WORDS = 25
#: Odd multipliers of the two hashes of a run.
_BASES = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93))
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


#: White space, and a number for every byte in either hash.
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_BYTES = tuple(_mix(np.arange(1, 257, dtype=np.uint64) * b) for b in _BASES)
#: Bytes of a text that are hashed at a time (up to the next white space).
SLICE_BYTES = 1 << 20


class Hasher:
    """Hashes of words, and of runs of so many words, by two multipliers:
    differences of running sums, so no word is looked at by itself."""

    def __init__(self):
        self.back = [np.uint64(pow(int(b), -1, 1 << 64)) for b in _BASES]
        self.powers = {}

    def words(self, text: bytes, which: int = 0) -> np.ndarray:
        """Hashes of the words of a text."""
        out, low = [], 0
        while low < len(text):
            cut = _BLANK.search(text, low + SLICE_BYTES)
            high = cut.start() if cut else len(text)
            out.append(self._slice(np.frombuffer(text, np.uint8, high - low, low), which))
            low = high
        return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)

    def _slice(self, raw: np.ndarray, which: int) -> np.ndarray:
        edge = np.diff(np.concatenate([[0], (~_SPACE[raw]).astype(np.int8), [0]]).astype(np.int8))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[which][raw] * self._power(_BASES[which], len(raw)), dtype=np.uint64, out=sums[1:])
        return _mix((sums[end] - sums[start]) * self._power(self.back[which], len(raw))[start])

    def _power(self, base: np.uint64, n: int) -> np.ndarray:
        """The first n powers of a multiplier, mod 2^64."""
        if len(self.powers.get(base, ())) < n:
            steps = np.full(max(2 * n, 4096), base, dtype=np.uint64)
            steps[0] = 1
            self.powers[base] = np.cumprod(steps, dtype=np.uint64)
        return self.powers[base][:n]

    def runs(self, hashes: np.ndarray, width: int, which: int = 0) -> np.ndarray:
        """Hash of the run of ``width`` words from each word on."""
        m = len(hashes) - width + 1
        if m <= 0:
            return np.zeros(0, dtype=np.uint64)
        sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * self._power(_BASES[which], len(hashes)), dtype=np.uint64, out=sums[1:])
        return _mix((sums[width:] - sums[:m]) * self._power(self.back[which], m))


def fingerprints(lines: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` lines its smallest hash, whose six low bits
    tell the place (lines of one run differ in them)."""
    if len(lines) < width or width > 64:
        if width > 64:
            raise ValueError("more than 64 lines in a run")
        return np.zeros(0, dtype=np.uint64)
    least = (lines & ~_PLACE) | (np.arange(len(lines), dtype=np.uint64) & _PLACE)
    have = 1
    while have < width:  # minima of 2, 4, 8, ... lines
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least


_PLACE = np.uint64(63)


LINES = "doc_id long, rkey long, tkey binary, n_words int, places array<long>"


def _line_rows(batches, min_words: int, line_words: int):
    """A row per document of ``min_words`` words or more."""
    import xxhash
    hasher = Hasher()
    names = [x.split()[0] for x in LINES.split(", ")]
    for batch in batches:
        kept, digests, counts, places = [], [], [], []
        for i, text in enumerate(one_by_one(batch.column("text").cast(pa.binary()))):
            words = hasher.words(text)
            if len(words) < min_words:
                continue
            least = fingerprints(hasher.runs(words, line_words), min_words - line_words + 1)
            chosen = least[np.append(True, least[1:] != least[:-1])] & ~_PLACE  # one for each place
            kept.append(i)
            digests.append(xxhash.xxh3_128_digest(text))
            counts.append(len(words))
            places.append(chosen.view(np.int64))
        at = pa.array(kept, pa.int64())
        ends = np.append(0, np.cumsum([len(p) for p in places])).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(at), batch.column("rkey").take(at), pa.array(digests, pa.binary()),
             pa.array(counts, pa.int32()),
             pa.ListArray.from_arrays(ends, np.concatenate([np.zeros(0, np.int64), *places]))], names=names)
    del hasher
    give_back()


RUNS = "a long, b long, place long"
#: A place is a document's rank and a word's number, the latter in so many
#: bits: more words than a string of a row can hold in usual text (a text with
#: more is an error).
WORD_BITS = 29
#: Rows gathered before they leave a task.
GATHER_RUNS = 100_000


def _run_rows(batches, min_words: int, line_words: int):
    """The runs whose fingerprint occurs twice."""
    hasher = Hasher()
    held, n_held = [], 0

    def gathered():
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=["a", "b", "place"])

    for batch in batches:
        hot_lists, ranks = batch.column("hot"), batch.column("rank").to_pylist()
        for i, text in enumerate(one_by_one(batch.column("text").cast(pa.binary()))):
            words = hasher.words(text)
            if len(words) >= 1 << WORD_BITS:
                raise ValueError(f"a text of {len(words)} words")
            hot = hot_lists[i].values.to_numpy().view(np.uint64)
            chosen = fingerprints(hasher.runs(words, line_words), min_words - line_words + 1) & ~_PLACE
            at = np.flatnonzero(np.isin(chosen, hot))
            held.append((hasher.runs(words, min_words)[at].view(np.int64),
                         hasher.runs(hasher.words(text, 1), min_words, 1)[at].view(np.int64),
                         (ranks[i] << WORD_BITS) + at))
            n_held += len(at)
            if n_held >= GATHER_RUNS:
                yield gathered()
                held, n_held = [], 0
    if held:
        yield gathered()
    del hasher
    give_back()


def _key():
    """64 bits of a row's content; with the id they name a place."""
    return F.conv(F.substring(row_key(F.col("doc_id"), F.col("text")), 1, 15), 16, 10).cast("long")


def repeated_runs(df: DataFrame, min_words: int = MIN_WORDS, line_words: int = LINE_WORDS) -> DataFrame:
    """Staged table (doc_id, rkey, runs, n_words): for each document with
    later occurrences, the first words of the runs to delete; runs are null
    where the whole text is a copy."""
    rows = df.where("text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), _key().alias("rkey"), "text")
    lines = staged(rows.mapInArrow(lambda b: _line_rows(b, min_words, line_words), LINES), "lines")
    # whole copies, and repeated rows, which are one place
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rkey")
    copied = staged(lines.groupBy("tkey").agg(F.min(place).alias("top"), F.count("*").alias("n"))
                    .where("n > 1").select("tkey", "top"), "copied")
    among = staged(join_by_size(lines.select("tkey", "doc_id", "rkey", "n_words"), copied, "tkey")
                   .select("doc_id", "rkey", "n_words", (place == F.col("top")).alias("first")).distinct(), "among")
    whole = among.where("not first").select("doc_id", "rkey", "n_words")
    single = join_by_size(lines, copied.select("tkey"), "tkey", "left_anti").select("doc_id", "rkey", "places")
    firsts = join_by_size(lines, copied, "tkey").where(place == F.col("top")).dropDuplicates(["doc_id", "rkey"])
    places = single.union(firsts.select("doc_id", "rkey", "places")).select(
        "doc_id", "rkey", F.explode("places").alias("fp"))
    places = staged(places, "places")
    twice = staged(places.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp"), "twice")
    hot = staged(join_by_size(places, twice, "fp").groupBy("doc_id", "rkey").agg(
        F.collect_set("fp").alias("hot")), "hot")
    # documents by rank: a place is one number, in the order of the documents
    hot = running_sums(hot, [F.col("doc_id").isNull(), F.col("doc_id"), F.col("rkey")],
                       {"rank": F.lit(1).cast("long")})
    # only texts with a repeated fingerprint move
    same = [F.col("r.doc_id").eqNullSafe(F.col("h.doc_id")), F.col("r.rkey") == F.col("h.rkey")]
    texts = rows.alias("r")
    if hot.count() <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(hot.select("doc_id", "rkey").alias("h")), same, "left_semi").alias("r")
    near = texts.join(hot.hint("merge").alias("h"), same).select("r.text", "h.rank", "h.hot")
    runs = staged(near.mapInArrow(lambda b: _run_rows(b, min_words, line_words), RUNS), "runs")
    tops = staged(runs.groupBy("a", "b").agg(F.min("place").alias("top"), F.count("*").alias("n"))
                  .where("n > 1").select("a", "b", "top"), "tops")
    rank = F.shiftright("place", WORD_BITS)
    later = runs.join(tops, ["a", "b"]).where((rank != F.shiftright("top", WORD_BITS)) | (
        F.col("place") >= F.col("top") + min_words))
    word = F.col("place").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
    cut = later.groupBy(rank.alias("rank")).agg(F.collect_set(word).alias("runs")).join(
        hot.select("rank", "doc_id", "rkey"), "rank").drop("rank")
    return staged(cut.withColumn("n_words", F.lit(None).cast("int")).unionByName(
        whole.withColumn("runs", F.lit(None).cast("array<int>"))), "later")


def cut_words(text: bytes, runs: list[int] | None, min_words: int) -> tuple[bytes, int]:
    """The text without the words of the runs, and their number; None: without
    all of its words."""
    word = ~_SPACE[np.frombuffer(text, np.uint8)]
    starts = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    if len(word) and word[0]:
        starts = np.append(0, starts)
    n = len(starts)
    if not n:
        return text, 0
    edge = np.zeros(n + 1, dtype=np.int64)
    if runs is None:
        edge[0] = 1
    else:
        np.add.at(edge, runs, 1)
        np.add.at(edge, np.asarray(runs) + min_words, -1)
    kept = np.cumsum(edge)[:-1] <= 0
    # a word reaches to the next one's start; kept stretches are taken whole
    ends = np.append(starts, len(text))
    turn = np.diff(np.concatenate([[0], kept.astype(np.int8), [0]]))
    parts = [text[ends[a]:ends[b]] for a, b in zip(np.flatnonzero(turn == 1), np.flatnonzero(turn == -1))]
    return b"".join([text[:starts[0]], *parts]), int(n - kept.sum())


def delete_runs(df: DataFrame, min_words: int = MIN_WORDS, line_words: int = LINE_WORDS) -> DataFrame:
    """``df`` with texts rewritten, and the number of words deleted
    (__n_removed)."""
    found = repeated_runs(df.select("doc_id", "text"), min_words, line_words)
    found = found.select(F.col("doc_id").alias("__doc"), F.col("rkey").alias("__rkey"), F.col("runs").alias("__runs"))
    keyed = df.withColumn("__key", _key())
    same = [F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")), F.col("__key") == F.col("__rkey")]
    keys = found.select("__doc", "__rkey")
    if keys.count() <= BROADCAST_ROWS:
        changed = keyed.join(F.broadcast(keys), same, "left_semi").join(found, same)
        plain = keyed.join(F.broadcast(keys), same, "left_anti").select(*df.columns)
    else:
        changed = keyed.join(found, same)
        plain = keyed.join(keys, same, "left_anti").select(*df.columns)
    at = df.columns.index("text")
    schema = T.StructType([*df.schema.fields, T.StructField("__n_removed", T.LongType())])

    def rewrite(batches):
        for batch in batches:
            texts, counts = [], []
            for text, runs in zip(batch.column(at).cast(pa.binary()), batch.column("__runs")):
                new, n = cut_words(text.as_py(), runs.as_py(), min_words)
                texts.append(new)
                counts.append(n)
            columns = [batch.column(i) for i in range(len(schema) - 1)]
            columns[at] = pa.array(texts, pa.binary()).view(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], names=schema.names)

    changed = changed.select(*[F.col(f"`{c}`") for c in df.columns], "__runs")
    return changed.mapInArrow(rewrite, schema).unionByName(
        plain.withColumn("__n_removed", F.lit(0).cast("long")))


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = delete_runs(documents(spark, sf_dir, "doc_id", "text"))
    return out.withColumnRenamed("__n_removed", "n_removed")


SQL = rf"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, md5(text)) AS rid, doc_id, text,
                  regexp_extract(text, '^[\x20\x09-\x0D]*') AS head,
                  regexp_extract_all(text, '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*') AS pieces,
                  regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents),
runs AS (SELECT rid, i, md5(array_to_string(ws[i:i + {MIN_WORDS - 1}], ' ')) AS run FROM (
           SELECT rid, ws, unnest(range(1, len(ws) - {MIN_WORDS - 2})) AS i FROM d WHERE len(ws) >= {MIN_WORDS})),
tops AS (SELECT *, min((rid, i)) OVER (PARTITION BY run) AS top FROM runs),
gone AS (SELECT rid, list(DISTINCT j) AS cut FROM (
           SELECT rid, unnest(range(i, i + {MIN_WORDS})) AS j FROM tops
           WHERE rid <> top[1] OR i >= top[2] + {MIN_WORDS}) GROUP BY rid)
SELECT doc_id,
       CASE WHEN cut IS NULL THEN text ELSE head || coalesce(array_to_string(list_transform(list_filter(
         range(1, len(pieces) + 1), lambda i: NOT list_contains(cut, i)), lambda i: pieces[i]), ''), '') END AS text,
       coalesce(len(cut), 0)::BIGINT AS n_removed
FROM d LEFT JOIN gone USING (rid)
"""
