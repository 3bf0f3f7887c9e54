"""Byte-level BPE vocabulary learning.

The corpus is reduced once to its word histogram (A4, a partial/final
aggregate, so hot words are pre-aggregated map-side).  Merge rounds then
touch only the distinct-word table and the table of its weighted adjacent
pairs (A5), which is kept by differences: a round decides a batch of merges
that provably equals one-at-a-time greedy selection, from the distinct pieces
of words that its pairs make up, and rewrites the words that hold one of them.
Words reduced to one symbol leave the table.  Each
round's tables are written to the shared folder; older ones are removed.
"""

from __future__ import annotations

import heapq
import time
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokloom.config import MIN_FREQ, PRETOKENIZE_RE, SPECIALS, VOCAB_SIZE
from tokloom.functions.bytelevel import (ALPHABET, token_hex,
                                         utf8_byte_ids, utf8_byte_values)
from tokloom.operators.words import char_classes, slices, words_of
from tokloom.session import remove_tree, scratch


def pretokenize(text) -> "F.Column":
    """Words of a text (byte-level pre-tokenizer, no prefix space)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(t, F.lit(PRETOKENIZE_RE), 0)


#: Characters of a text that are cut into words at a time (a piece ends at the
#: next place where no word can go on).
PIECE_CHARS = 1 << 20
#: Such places: before white space that follows something else, and where
#: letters or digits end.  A word of the pre-tokenizer begins with its only
#: space, holds one class of characters, and only an apostrophe has letters
#: behind it.
_SAFE = r"(?:(?<=\S)(?=\s)|(?<=\p{L})(?=[^\p{L}\s])|(?<=\p{N})(?=[^\p{N}\s]))"


def text_pieces(text, chars: int = PIECE_CHARS) -> "F.Column":
    """A text as consecutive pieces of ``chars`` characters and up to the next
    safe place; the words of the pieces are the words of the text.  Short
    texts are one piece."""
    t = F.col(text) if isinstance(text, str) else text
    cut = F.regexp_extract_all(t, F.lit(rf"(?Us).{{{chars}}}.*?{_SAFE}|.+"), F.lit(0))
    return F.when(F.length(t) > chars, cut).otherwise(F.array(t))


#: Distinct words that a task gathers before it hands them on.
GATHERED_WORDS = 250_000


def word_histogram(docs: DataFrame, text_col: str = "text", strip: bool = True,
                   piece_chars: int = PIECE_CHARS) -> DataFrame:
    """A4: (word, n) over all documents (stripped, blanks dropped).  A task
    counts the words of its texts a slice at a time; long texts are cut into
    pieces first, so nothing holds the words of a whole one."""
    classes = char_classes(docs.sparkSession)

    def summed(counts):
        return pa.Table.from_batches(counts).group_by("word", use_threads=False).aggregate([("n", "sum")]) \
            .combine_chunks().rename_columns(["word", "n"])

    def count(batches):
        counts, rows, least = [], 0, 0
        for batch in batches:
            for _, _, data, _, edges in slices(batch.column(0), strip, piece=piece_chars):
                for _, words in words_of(data, edges, classes):
                    c = words.value_counts()
                    counts.append(pa.RecordBatch.from_arrays([c.field("values"), c.field("counts")], names=["word", "n"]))
                    rows += len(c)
            if rows > least + GATHERED_WORDS:
                counts = summed(counts).to_batches()
                rows = least = sum(len(c) for c in counts)
                if rows > GATHERED_WORDS:
                    yield from counts
                    counts, rows, least = [], 0, 0
        if counts:
            yield from summed(counts).to_batches()
        pa.default_memory_pool().release_unused()  # the worker stays

    return (docs.select(F.col(text_col).cast("string").alias("_t")).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")))


def byte_histogram(words: DataFrame) -> DataFrame:
    """Alphabet actually used: byte value -> weighted occurrences."""
    return (words.select(F.explode(utf8_byte_values(F.col("word"))).alias("byte"), "n")
            .groupBy("byte").agg(F.sum("n").alias("n")))


def byte_pair_counts(words: DataFrame) -> DataFrame:
    """A5 on the initial alphabet: weighted counts of adjacent byte pairs."""
    b = utf8_byte_values(F.col("word"))
    pairs = F.zip_with(b, F.slice(b, 2, F.greatest(F.size(b) - 1, F.lit(1))),
                       lambda x, y: F.struct(x.alias("left"), y.alias("right")))
    return (words.select(F.explode(pairs).alias("p"), "n")
            .where(F.col("p.right").isNotNull())
            .groupBy(F.col("p.left").alias("left_byte"), F.col("p.right").alias("right_byte"))
            .agg(F.sum("n").alias("n")))


@dataclass
class BpeModel:
    """Learned vocabulary: id -> token (byte-level string) and the ordered
    merge list.  Bounded by ``vocab_size``; lives on the driver and is
    shipped to tasks as a broadcast."""

    tokens: list[str]
    n_special: int
    merges: list[tuple[int, int, int]] = field(default_factory=list)  # (left, right, new)
    rounds: int = 0
    timings: list = field(default_factory=list)

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        rows = [(i, t, i < self.n_special, None if i < self.n_special else token_hex(t))
                for i, t in enumerate(self.tokens)]
        return spark.createDataFrame(rows, "id int, token string, is_special boolean, hex string")

    def merges_df(self, spark: SparkSession) -> DataFrame:
        rows = [(r, self.tokens[a], self.tokens[b], self.tokens[m], a, b, m)
                for r, (a, b, m) in enumerate(self.merges)]
        return spark.createDataFrame(
            rows, "rank int, left string, right string, merged string, "
                  "left_id int, right_id int, merged_id int")


def base_model(specials=SPECIALS) -> BpeModel:
    return BpeModel(tokens=list(specials) + list(ALPHABET), n_special=len(specials))


#: Pairs a round looks at, pairs the first round asks for, and symbols of the
#: pieces that the driver may hold while it plays ahead.
CANDIDATES, FIRST_PAIRS, AHEAD_SYMBOLS = 20_000, 64, 500_000


def train_bpe(words: DataFrame, vocab_size: int, min_freq: int = MIN_FREQ, specials=SPECIALS,
              candidates: int = CANDIDATES, ahead_symbols: int = AHEAD_SYMBOLS) -> BpeModel:
    """Learn merges from a (word, n) histogram.

    Greedy rule: the pair with the highest weighted count, ties to the
    smaller (left id, right id); stop at ``vocab_size`` tokens or when the
    best count is below ``min_freq``.  A merged string that already exists
    reuses its id (the vocabulary does not grow).

    The pair counts are a table of their own.  A round takes the best
    ``candidates`` pairs from it, decides as many merges as it can be sure
    of, rewrites the words that hold one of them in one pass, and adds the
    difference of their pairs to the table.  There are two ways to be sure:

    * Playing ahead.  Some of the best pairs are taken, and every word is cut
      where two neighbours are none of them.  An occurrence of a pair that a
      merge creates goes back to two such neighbours, so across a cut no pair
      ever counts more than the first pair that was not taken, nor comes
      before it.  Merges before that pair are therefore decided by the pieces
      alone, and equal pieces of all words are one row: as many pairs are
      taken as keep the distinct pieces within ``ahead_symbols`` symbols.  A
      merge that reuses an id ends the round: its symbol has neighbours
      elsewhere.
    * A prefix of the sorted pairs (if the pieces of a single pair are too
      many): a pair joins when its occurrences cannot overlap an accepted
      pair's and its count is above every count a new pair can reach.
    """
    # Rounds are small jobs: adaptive re-planning only adds fixed latency to
    # each.  The loop runs in a session of its own, so the caller's settings
    # are never touched.
    spark = words.sparkSession.newSession()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    model = base_model(specials)
    token_id = {t: i for i, t in enumerate(model.tokens)}
    cur = _initial_words(spark, words, model.n_special)
    # round shuffles are sized like the word table: pair tables are a small multiple of it
    spark.conf.set("spark.sql.shuffle.partitions", str(max(1, cur.rdd.getNumPartitions())))
    pairs = _written(_counted(_pair_rows(cur)), "pairs")
    asked = FIRST_PAIRS
    while len(model.tokens) < vocab_size:
        model.rounds += 1
        t0 = time.time()
        best = _best(pairs, candidates + 1, min_freq)
        if not best:
            break
        taken, held, rows = _neighbourhood(cur, best[:min(candidates, asked)], ahead_symbols)
        done = len(model.merges)
        if taken:
            limit = best[taken] if taken < len(best) else (0, 0, 0)
            _play_ahead(model, token_id, best[:taken], rows, limit, vocab_size, min_freq)
        if len(model.merges) == done:
            after_r, before_l = _symbol_maxima(pairs)
            _select_batch(model, token_id, best, after_r, before_l, vocab_size, min_freq)
        # pieces grow faster than the pairs they hold
        asked = max(1, int(max(taken, 1) * min(4.0, (ahead_symbols / max(held, 1)) ** 0.5)))
        if len(model.tokens) < vocab_size:
            rewritten = _written(_rewrite(cur, model.merges[done:]), "words")
            pairs_next = _written(_counted(pairs.union(
                rewritten.where("syms is null").select("l", "r", "c"))), "pairs")
            _drop(pairs)
            _drop(cur)
            cur, pairs = rewritten.where("syms is not null").select("syms", "freq"), pairs_next
        model.timings.append(time.time() - t0)
    _drop(pairs)
    _drop(cur)
    return model


def _best(pairs: DataFrame, n: int, min_freq: int) -> list[tuple]:
    """The first ``n`` pairs as (-count, left, right), none below ``min_freq``."""
    top = pairs.where(F.col("c") >= min_freq).orderBy(F.desc("c"), "l", "r").limit(n).toArrow()
    c, left, right = (top.column(k).to_pylist() for k in ("c", "l", "r"))
    return [(-n, a, b) for n, a, b in zip(c, left, right)]


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lost executors read it again."""
    path = scratch(df.sparkSession, f"bpe-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _drop(df: DataFrame) -> None:
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove_tree(df.sparkSession, path)


def _initial_words(spark, words: DataFrame, first: int) -> DataFrame:
    """(syms, freq): each word as alphabet ids; one-symbol words never form a
    pair and are left out."""
    path = scratch(spark, "bpe-words")
    (words.select(utf8_byte_ids(F.col("word"), first).alias("syms"), F.col("n").cast("long").alias("freq"))
     .where(F.size("syms") > 1).write.parquet(path))
    return spark.read.parquet(path)


def _pair_rows(words: DataFrame) -> DataFrame:
    pairs = F.zip_with(F.slice("syms", F.lit(1), F.size("syms") - 1), F.slice("syms", F.lit(2), F.size("syms")),
                       lambda x, y: F.struct(x.alias("l"), y.alias("r")))
    return words.select(F.explode(pairs).alias("p"), F.col("freq").alias("c")).select("p.l", "p.r", "c")


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("l", "r").agg(F.sum("c").alias("c")).where("c <> 0")


def _symbol_maxima(pairs: DataFrame) -> tuple[dict, dict]:
    """For every symbol its largest count as a left and as a right member;
    the rows are bounded by the vocabulary."""
    return tuple({r["s"]: r["c"] for r in pairs.groupBy(F.col(side).alias("s")).agg(
        F.max("c").alias("c")).collect()} for side in ("l", "r"))


def _codes(syms: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Code of the pair from each symbol on, -1 at a word's last."""
    code = np.full(len(syms), -1)
    code[:-1] = syms[:-1] << 32 | syms[1:]
    code[ends[1:] - 1] = -1
    return code


def _flat(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, ends of the words, codes of the pairs)."""
    lists = batch.column("syms")
    ends = lists.offsets.to_numpy().astype(np.int64)
    syms = lists.flatten().to_numpy().astype(np.int64)
    ends = ends - ends[0]
    return syms, ends, _codes(syms, ends)


def _sorted_codes(pairs) -> np.ndarray:
    return np.sort(np.array([a << 32 | b for a, b in pairs], dtype=np.int64))


def _cut(syms: np.ndarray, code: np.ndarray, joined: np.ndarray):
    """(start, end, binary array) of the pieces of two symbols or more that stay
    when words are cut between neighbours that are none of ``joined``."""
    hit = joined[np.minimum(np.searchsorted(joined, code), len(joined) - 1)] == code
    end = np.flatnonzero(~hit) + 1
    start = np.concatenate([[0], end[:-1]])
    most = np.flatnonzero(end - start > 1)
    edges = pa.py_buffer(np.concatenate([[0], end * 4]).astype(np.int32))
    pieces = pa.Array.from_buffers(pa.binary(), len(end), [None, edges, pa.py_buffer(syms.astype(np.int32))])
    return start[most], end[most], pieces.take(pa.array(most))


def _lists(pieces: pa.Array) -> pa.ListArray:
    """Binary pieces as lists of symbols."""
    flat = np.frombuffer(b"".join(pieces.to_pylist()), dtype=np.int32)
    edges = np.concatenate([[0], np.cumsum(pc.binary_length(pieces).to_numpy() // 4)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))


def _pieces(words: DataFrame, pairs: list[tuple]) -> DataFrame:
    """(syms, freq): the distinct pieces of the words, cut between neighbours
    that are none of ``pairs``, and how often they occur."""
    joined = _sorted_codes(pairs)

    def cut(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            syms, ends, code = _flat(batch)
            start, _, pieces = _cut(syms, code, joined)
            of = np.searchsorted(ends, start, side="right") - 1
            t = pa.table({"p": pieces, "n": batch.column("freq").take(pa.array(of))}).group_by("p").aggregate(
                [("n", "sum")]).combine_chunks()
            if t.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [_lists(t.column("p").chunk(0)), t.column("n_sum").chunk(0)], names=["syms", "freq"])

    return words.mapInArrow(cut, "syms array<int>, freq long").groupBy("syms").agg(F.sum("freq").alias("freq"))


def _neighbourhood(words: DataFrame, best: list[tuple], most: int):
    """(how many of the best pairs have all their pieces among ``most`` symbols,
    how many symbols those are, the pieces).  Pieces of fewer pairs are cut from
    those of more."""
    near, taken = words, len(best)
    while taken and most:
        nearer = _written(_pieces(near, [p[1:] for p in best[:taken]]), "near")
        if near is not words:
            _drop(near)
        near = nearer
        held = near.agg(F.coalesce(F.sum(F.size("syms")), F.lit(0))).first()[0]
        if held <= most:
            rows = near.toArrow()
            _drop(near)
            return taken, held, rows
        taken = int(taken * max(0.1, min(0.8, most / held)))
    if near is not words:
        _drop(near)
    return 0, most, None


def _play_ahead(model, token_id, exact, rows, limit, vocab_size, min_freq) -> None:
    """Greedy merges on the pieces at hand, as long as the next one comes before
    ``limit`` (count descending, ids ascending).  All pairs inside a piece are
    ``exact`` ones."""
    words = rows.column("syms").to_pylist()
    freqs = rows.column("freq").to_pylist()
    counts = {(a, b): -c for c, a, b in exact}
    where: dict = {p: set() for p in counts}
    for i, w in enumerate(words):
        for p in zip(w, w[1:]):
            where[p].add(i)
    heap = [(-c, *p) for p, c in counts.items()]
    heapq.heapify(heap)
    while heap and len(model.tokens) < vocab_size:
        item = heapq.heappop(heap)
        pair = item[1:]
        if counts.get(pair) != -item[0]:
            continue  # an older count
        if item >= limit or -item[0] < min_freq:
            return
        a, b = pair
        token = model.tokens[a] + model.tokens[b]
        reused = token in token_id
        if not reused:
            token_id[token] = len(model.tokens)
            model.tokens.append(token)
        new = token_id[token]
        model.merges.append((a, b, new))
        if reused:
            return
        changed = set()
        for i in where.pop(pair):
            old, f = words[i], freqs[i]
            out, k = [], 0
            while k < len(old):
                if old[k] == a and k + 1 < len(old) and old[k + 1] == b:
                    out.append(new)
                    k += 2
                else:
                    out.append(old[k])
                    k += 1
            for p in zip(old, old[1:]):
                if p in counts:
                    counts[p] -= f
                    changed.add(p)
            for p in zip(out, out[1:]):
                if new in p and p not in counts:
                    counts[p], where[p] = 0, set()
                if p in counts:
                    counts[p] += f
                    changed.add(p)
                    if p in where:
                        where[p].add(i)
            words[i] = out
        del counts[pair]
        for p in changed:
            if counts.get(p):
                heapq.heappush(heap, (-counts[p], *p))


def _select_batch(model, token_id, best, after_r, before_l, vocab_size, min_freq) -> None:
    """The longest sure prefix of the sorted pairs."""
    rights, lefts, bound = set(), set(), -1
    for c, a, b in best:
        token = model.tokens[a] + model.tokens[b]
        if -c < min_freq or len(model.tokens) >= vocab_size:
            return
        # occurrences of (a, b) can overlap an accepted (x, y) only when
        # b == x or a == y; shared left (or shared right) symbols cannot
        if lefts and (a in rights or b in lefts or -c <= bound or token in token_id):
            return
        if token in token_id:
            model.merges.append((a, b, token_id[token]))
            return
        token_id[token] = len(model.tokens)
        model.merges.append((a, b, len(model.tokens)))
        model.tokens.append(token)
        lefts.add(a)
        rights.add(b)
        bound = max(bound, min(-c, max(after_r.get(b, 0), before_l.get(a, 0))))


def _joined_by(merges: list[tuple]) -> list[tuple]:
    """Pairs of neighbouring symbols, as they are before the merges, that one of
    the merges brings together."""
    first, last, found = {}, {}, set()
    for a, b, m in merges:
        found.add((last.get(a, a), first.get(b, b)))
        first[m], last[m] = first.get(a, a), last.get(b, b)
    return sorted(found)


def _summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of pairs and the sums of their numbers, zeros left out."""
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    at = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    total = np.add.reduceat(n, at) if len(at) else n
    some = total != 0
    return code[at][some], total[some]


#: Pairs whose differences a task gathers before it hands them on.
DELTA_PAIRS = 500_000


def _rewrite(words: DataFrame, merges: list[tuple]) -> DataFrame:
    """(syms, freq) with the merges applied, words of one symbol left out, and
    rows (l, r, c) of what that changes in the pair counts.  Pieces that the
    merges can join are merged once a batch and put back in place."""
    joined = _sorted_codes(_joined_by(merges))
    ranks = {(a, b): (i, m) for i, (a, b, m) in enumerate(merges)}

    def apply(batches):
        from tokloom.operators.encode import merge_word
        delta: list = []
        for batch in batches:
            if not batch.num_rows:
                continue
            syms, ends, code = _flat(batch)
            freq = batch.column("freq").to_numpy()
            start, end, pieces = _cut(syms, code, joined)
            coded = pieces.dictionary_encode()
            merged = pa.array([merge_word(np.frombuffer(p, dtype=np.int32).tolist(), ranks)
                               for p in coded.dictionary.to_pylist()], pa.list_(pa.int32())).take(coded.indices)
            size = pc.list_value_length(merged).to_numpy(zero_copy_only=False).astype(np.int64)
            begin = np.cumsum(size) - size
            new, keep = syms.copy(), np.ones(len(syms) + 1, dtype=np.int64)
            new[np.repeat(start - begin, size) + np.arange(size.sum())] = merged.flatten().to_numpy()
            gone = end - start - size
            keep[np.repeat(start + size - (np.cumsum(gone) - gone), gone) + np.arange(gone.sum())] = 0
            kept = np.concatenate([[0], np.cumsum(keep[:-1])])
            new, edges = new[keep[:-1] == 1], kept[ends]
            after = _codes(new, edges)
            touched = np.diff(edges) != np.diff(ends)
            old_at, new_at = np.repeat(touched, np.diff(ends)) & (code >= 0), np.repeat(touched, np.diff(edges)) & (after >= 0)
            delta.append(_summed(np.concatenate([code[old_at], after[new_at]]), np.concatenate(
                [-np.repeat(freq, np.diff(ends))[old_at], np.repeat(freq, np.diff(edges))[new_at]])))
            lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(new.astype(np.int32)))
            long = pa.array(np.diff(edges) > 1)
            out = lists.filter(long)
            yield pa.RecordBatch.from_arrays([out, batch.column("freq").filter(long), *_nulls(len(out))], names=_ROUND)
            if sum(len(d[0]) for d in delta) > DELTA_PAIRS:
                yield _delta_rows(delta)
                delta = []
        yield _delta_rows(delta)

    return words.mapInArrow(apply, "syms array<int>, freq long, l int, r int, c long")


_ROUND = ["syms", "freq", "l", "r", "c"]


def _nulls(n: int) -> list:
    return [pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())]


def _delta_rows(delta: list) -> pa.RecordBatch:
    code, n = _summed(*(np.concatenate([d[k] for d in delta] or [np.zeros(0, np.int64)]) for k in (0, 1)))
    return pa.RecordBatch.from_arrays(
        [pa.nulls(len(n), pa.list_(pa.int32())), pa.nulls(len(n), pa.int64()),
         pa.array((code >> 32).astype(np.int32)), pa.array((code & 0xFFFFFFFF).astype(np.int32)),
         pa.array(n, pa.int64())], names=_ROUND)


def learn_vocab(docs: DataFrame, vocab_size: int = VOCAB_SIZE, text_col: str = "text",
                min_freq: int = MIN_FREQ, **kw) -> BpeModel:
    """T1 -> A4 -> T2."""
    return train_bpe(word_histogram(docs, text_col), vocab_size, min_freq, **kw)
