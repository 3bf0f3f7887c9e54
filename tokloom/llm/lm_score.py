"""LM scoring by subword lattice likelihood.

The model is a unigram model over the pieces of an existing vocabulary.  A
word with its leading space is a lattice of all its segmentations; a
segmentation weighs the product of its pieces' probabilities, and a forward
recursion in log space sums over all of them.  Pieces never reach over a
space, so a document's marginal probability is the product over its words
and one end token.  Bytes without a piece of their own are pieces too, so
every text has a probability.  The vocabulary is taken as it is; piece
probabilities are learned from the whole training side: its words, each as
often as it occurs, are segmented by the existing tokenizer and the pieces
counted.

Work per word, not per occurrence: words are counted over the whole corpus
(combined in each task, then shuffled), and each distinct word passes the
lattice once.  Documents meet the scores in two ways.  The ``FREQUENT`` most
frequent words, a bounded table, are broadcast and resolve most occurrences
without moving them, the hot words among them; the others go through an
equi-join on the word.  No count is approximate and no word is left out.

Defined cases: a null or empty text is the end token alone; a null id counts
as the empty text where rows are held out; words of any length are scored
whole; repeated rows are scored each and count each in training; without
training tokens every count is 0; an empty table gives no rows; columns
other than the two named are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokloom.llm.common import documents, id_crc32, staged

MODEL = "piece_bpe_32k.model"
FREQUENT = 1 << 18
SMOOTHING = 0.1
#: Words gathered before counts leave a task, and words scored at a time.
GATHER, CHUNK = 400_000, 100_000
END = b""  # words are never empty


def held_out(doc_id: Column, fold: int = 10) -> Column:
    return id_crc32(doc_id) % fold == 0


def words_of(text: str) -> list[bytes]:
    """ASCII lower case, ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split()


class Vocabulary:
    """Pieces of the existing tokenizer as byte strings, a space standing for
    the start of a word; single bytes fill the gaps."""

    def __init__(self, model: str | None = None):
        import public_tokenizers
        import sentencepiece
        self.tokenizer = sentencepiece.SentencePieceProcessor(
            model_file=model or public_tokenizers.path(MODEL))
        t, self.of_id, pieces = self.tokenizer, {}, {END: 0}
        for i in range(t.get_piece_size()):
            if t.is_control(i) or t.is_unknown(i):
                continue
            if t.is_byte(i):
                s = bytes([int(t.id_to_piece(i)[1:-1], 16)])
            else:
                s = t.id_to_piece(i).replace("▁", " ").encode()
                if b" " in s[1:]:
                    continue
            self.of_id[i] = pieces.setdefault(s, len(pieces))
        for b in range(256):
            pieces.setdefault(bytes([b]), len(pieces))
        self.pieces = list(pieces)

    def count(self, words: list[bytes], counts: list[int]) -> np.ndarray:
        total = np.zeros(len(self.pieces), dtype=np.int64)
        texts = [w.decode("utf-8", "replace") for w in words]
        for ids, n in zip(self.tokenizer.encode(texts, num_threads=1), counts):
            for i in ids:
                p = self.of_id.get(i)
                if p is not None:
                    total[p] += n
        return total


class Lattice:
    """Marginal log probabilities of words over all segmentations."""

    _P = np.uint64(0x100000001B3)

    def __init__(self, pieces: list[bytes], logp: np.ndarray):
        self.longest = max(len(p) for p in pieces)
        self.end = float(logp[pieces.index(END)])
        self.byte = np.zeros(256)
        self.tables = {}
        by_len: dict[int, list] = {}
        for p, lp in zip(pieces, logp):
            if len(p) == 1:
                self.byte[p[0]] = lp
            elif p:
                by_len.setdefault(len(p), []).append((self._hash(p), lp))
        for n, rows in by_len.items():
            rows.sort()
            self.tables[n] = (np.array([h for h, _ in rows], dtype=np.uint64),
                              np.array([x for _, x in rows]))

    def _hash(self, piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(self._P) + b + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def arcs(self, chars: np.ndarray):
        """For each piece length n, (words x starts) log probabilities of the
        piece from each start, -inf where there is none."""
        h = np.zeros((chars.shape[0], chars.shape[1] + 1), dtype=np.uint64)
        wide = chars.astype(np.uint64) + np.uint64(1)
        found = {1: self.byte[chars]}
        for n in range(1, min(self.longest, chars.shape[1]) + 1):
            h = h[:, :chars.shape[1] - n + 1] * self._P + wide[:, n - 1:]
            if n in self.tables:
                keys, lp = self.tables[n]
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hit = keys[at] == h
                if hit.any():
                    found[n] = np.where(hit, lp[at], -np.inf)
        return found

    def equal_length(self, chars: np.ndarray) -> np.ndarray:
        """chars: one row of bytes for each word, the leading space included."""
        m, length = chars.shape
        found = self.arcs(chars)
        if m == 1:
            alpha = [0.0] * (length + 1)
            lists = {n: a[0].tolist() for n, a in found.items()}
            for j in range(1, length + 1):
                ways = [alpha[j - n] + a[j - n] for n, a in lists.items() if n <= j]
                top = max(ways)
                alpha[j] = top + math.log(sum(math.exp(w - top) for w in ways))
            return np.array([alpha[length]])
        alpha = np.full((length + 1, m), -np.inf)
        alpha[0] = 0.0
        for j in range(1, length + 1):
            for n, a in found.items():
                if n <= j:
                    alpha[j] = np.logaddexp(alpha[j], alpha[j - n] + a[:, j - n])
        return alpha[length]

    def words(self, words: list[bytes]) -> np.ndarray:
        out = np.empty(len(words))
        by_len: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_len.setdefault(len(w), []).append(i)
        for n, at in by_len.items():
            if n == 0:
                out[at] = self.end
                continue
            step = max(1, 4_000_000 // n)  # bytes of words at a time
            for k in range(0, len(at), step):
                part = at[k:k + step]
                flat = np.frombuffer(b"".join(b" " + words[i] for i in part), np.uint8)
                out[part] = self.equal_length(flat.reshape(len(part), n + 1))
        return out


def _word_counts(batches):
    """(word, training count) of each task's documents; words of held-out
    documents alone come with 0."""
    counts, others = Counter(), set()

    def rows():
        names = [*counts, *(w for w in others if w not in counts)]
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array([counts[w] for w in names], pa.int64())],
            names=["word", "c"])

    for batch in batches:
        for text, out in zip(batch.column("text").to_pylist(), batch.column("held_out").to_pylist()):
            if out:
                others.update(words_of(text or ""))
                others.add(END)
            else:
                counts.update(words_of(text or ""))
                counts[END] += 1
        if len(counts) + len(others) > GATHER:
            yield rows()
            counts.clear()
            others.clear()
    yield rows()


def _batched(batches, rows: int):
    """Record batches joined to about ``rows`` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def word_table(df: DataFrame, model: str | None = None) -> tuple[DataFrame, int]:
    """(table (word, c, base, lp), N): training count and log10
    probabilities, by count and by lattice, of every word of ``df`` (text,
    held_out), the end token included."""
    spark = df.sparkSession
    counts = staged(df.select("text", "held_out").mapInArrow(_word_counts, "word binary, c long")
                    .groupBy("word").agg(F.sum("c").alias("c")), "words")
    seen = counts.agg(F.sum("c").alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v")).first()
    n, v = seen["n"] or 0, seen["v"] or 0

    def pieces(batches):
        vocab, total = Vocabulary(model), 0
        for batch in batches:
            words, c = batch.column("word").to_pylist(), batch.column("c").to_pylist()
            total = total + vocab.count(words, c)
            total[0] += sum(k for w, k in zip(words, c) if w == END)
        if np.any(total):
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["piece", "n"])

    vocab = Vocabulary(model)
    total = np.zeros(len(vocab.pieces))
    # at most one row for each piece of the vocabulary
    for r in (counts.where("c > 0").mapInArrow(pieces, "piece long, n long")
              .groupBy("piece").agg(F.sum("n").alias("n")).collect()):
        total[r["piece"]] = r["n"]
    logp = np.log((total + SMOOTHING) / (total.sum() + SMOOTHING * len(total)))
    shared = spark.sparkContext.broadcast((vocab.pieces, logp))

    def score(batches):
        lattice = Lattice(*shared.value)
        for table in _batched(batches, CHUNK):
            words = table.column("word").to_pylist()
            lp = lattice.words(words) / math.log(10)
            c = table.column("c").to_numpy()
            base = np.log10((c + SMOOTHING) / (n + SMOOTHING * (v + 1)))
            yield from pa.table({"word": table.column("word"), "c": table.column("c"),
                                 "base": base, "lp": lp}).to_batches()

    scored = counts.mapInArrow(score, "word binary, c long, base double, lp double")
    return staged(scored, "scored"), n


def _most_frequent(table: DataFrame, most: int) -> list:
    """The words with the highest counts, at most ``most``: a histogram over
    eighths of powers of two (a few hundred rows) tells from which count on."""
    step = F.floor(F.log2("c") * 8).cast("int")
    words = table.where("c > 0").groupBy(step.alias("step")).count().collect()
    taken, low = 0, None
    for r in sorted(words, key=lambda r: -r["step"]):
        taken += r["count"]
        if taken > most:
            break
        low = r["step"]
    return table.where((F.col("c") > 0) & (step >= low)).collect() if low is not None else []


PARTS = ("rid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, "
         "lp double, words array<binary>, times array<int>")


def score_documents(df: DataFrame, model: str | None = None, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every row of ``df`` (doc_id, text, held_out)."""
    spark = df.sparkSession
    table, n = word_table(df, model)
    top = _most_frequent(table, frequent)
    shared = spark.sparkContext.broadcast((
        [bytes(r["word"]) for r in top], np.array([r["c"] > 0 for r in top], dtype=bool),
        np.array([r["base"] for r in top]), np.array([r["lp"] for r in top])))

    def parts(batches):
        from pyspark import TaskContext
        words, known, base, lp = shared.value
        place = {w: i for i, w in enumerate(words)}
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for doc, text, out in zip(*(batch.column(c).to_pylist()
                                        for c in ("doc_id", "text", "held_out"))):
                tokens = words_of(text or "")
                tokens.append(END)
                at = [place.get(w, -1) for w in tokens]
                hits = np.array(at)
                hits = hits[hits >= 0]
                rest = Counter(w for w, i in zip(tokens, at) if i < 0)
                rows.append((rid, doc, out, len(tokens), int(known[hits].sum()),
                             float(base[hits].sum()), float(lp[hits].sum()),
                             list(rest), list(rest.values())))
                rid += 1
            cols = list(zip(*rows)) or [()] * 9
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(),
                     pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=[x.split()[0] for x in PARTS.split(", ")])

    docs = staged(df.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "held_out")
                  .mapInArrow(parts, PARTS), "parts")
    rest = docs.select("rid", F.explode(F.arrays_zip("words", "times")).alias("x")).select(
        "rid", F.col("x.words").alias("word"), F.col("x.times").alias("k"))
    found = (rest.join(table, "word").groupBy("rid").agg(
        F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("r_known"),
        F.sum(F.col("k") * F.col("base")).alias("r_base"), F.sum(F.col("k") * F.col("lp")).alias("r_lp")))
    zero = F.lit(0)
    return docs.drop("words", "times").join(found, "rid", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("r_known", zero)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("r_base", zero)).alias("base_score"),
        (F.col("lp") + F.coalesce("r_lp", zero)).alias("score"))


def op7_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return score_documents(docs.withColumn("held_out", held_out(F.col("doc_id"))))
