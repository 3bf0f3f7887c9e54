"""Best-fit decreasing packing of token sequences.

Best-fit decreasing looks at lengths only, so the whole corpus enters it as
a histogram of at most ``capacity`` numbers, however many documents there
are.  Lengths go in from the longest; the tightest open bin is found by a
segment tree over remaining capacities (presence bits, one descent per
lookup), and all bins with the same remaining capacity that are numbered in
a row move as one group: best fit fills the bin it has just used until the
length no longer fits, so k items of one length go to each bin of a group.
The outcome is exactly that of placing the documents one at a time, written
as a short list of moves (a few per length and group).

Spark does the rest: one pass tokenizes the texts and emits pieces, numbered
per task and length; counts per (task, length) turn these into ranks per
length over the whole corpus; a broadcast of the moves (bounded by the
capacity, not the data) maps (length, rank) to sequence and offset.  No
group of pieces ever meets in one task.

Defined cases: a null or empty text is the end id alone; a text longer than
``capacity`` is cut, the first piece being the shorter one; repeated rows
are packed once each; an empty table gives no rows; columns other than the
two named are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokloom.llm.common import documents, join_by_size, staged

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"


class CapacityTree:
    """Presence of open bins by remaining capacity."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.node = np.zeros(2 * self.leaves, dtype=bool)

    def put(self, remaining: int, present: bool):
        i = self.leaves + remaining
        self.node[i] = present
        while i > 1:
            i >>= 1
            self.node[i] = self.node[2 * i] or self.node[2 * i + 1]

    def tightest(self, need: int) -> int | None:
        """Smallest remaining capacity of at least ``need``."""
        i = self.leaves + need
        if self.node[i]:
            return need
        while i > 1 and not (i % 2 == 0 and self.node[i + 1]):
            i >>= 1
        if i <= 1:
            return None
        i += 1
        while i < self.leaves:
            i = 2 * i if self.node[2 * i] else 2 * i + 1
        return i - self.leaves


def best_fit_moves(counts: dict[int, int], capacity: int = CAPACITY):
    """(moves, number of bins).  A move (length, rank, per_bin, first_bin,
    offset): the items of that length from ``rank`` on, until the next move,
    go ``per_bin`` each to the bins from ``first_bin`` on, at ``offset``."""
    tree, groups, moves, n_bins = CapacityTree(capacity), {}, [], 0

    def put(remaining, first, n):
        if n > 0:
            groups.setdefault(remaining, []).append((first, n))
            tree.put(remaining, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, n = capacity, -(-left // (capacity // length))
                first, n_bins = n_bins, n_bins + n
            else:
                first, n = groups[room].pop()
                if not groups[room]:
                    tree.put(room, False)
            per = room // length
            used = min(left, per * n)
            moves.append((length, rank, per, first, capacity - room))
            full, part = divmod(used, per)
            put(room - per * length, first, full)
            put(room - part * length, first + full, 1 if part else 0)
            put(room, first + full + (part > 0), n - full - (part > 0))
            rank, left = rank + used, left - used
    return moves, n_bins


def byte_alphabet() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves and the others,
    in order, as the code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def encoder(tokenizer: str | None = None, added_tokens: bool = False):
    """text -> uint32 ids, as the tokenizer file says.  The same ranks run
    in the faster of the installed libraries; a text whose white space runs
    are too long for its pattern goes to the other one.  With
    ``added_tokens``, the file's added tokens are single ids wherever they
    stand in a text, as in the library; else they are text like any other."""
    import json
    import re

    import public_tokenizers
    import tiktoken
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    added = {t["content"]: t for t in spec.get("added_tokens", ())}
    to_byte = byte_alphabet()
    ranks = {bytes(to_byte[c] for c in tok): i for tok, i in spec["model"]["vocab"].items()
             if tok not in added}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})
    slow = []

    def library(text: str) -> np.ndarray:
        if not slow:
            from tokenizers import Tokenizer
            slow.append(Tokenizer.from_file(path))
            slow[0].encode_special_tokens = not added_tokens
        return np.array(slow[0].encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, disallowed_special=())
        except ValueError:
            return library(text)

    if not added_tokens or not added:
        return encode
    # the longest of those that start at a place, as the library takes them
    find = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))))
    plain = spec.get("normalizer") is None and not any(
        t.get(x) for t in added.values() for x in ("single_word", "lstrip", "rstrip"))

    def encode_added(text: str) -> np.ndarray:
        if not find.search(text):
            return encode(text)
        if not plain:
            return library(text)
        parts, at = [], 0
        for m in find.finditer(text):
            parts += [encode(text[at:m.start()]), np.array([added[m.group()]["id"]], dtype=np.uint32)]
            at = m.end()
        return np.concatenate([*parts, encode(text[at:])])

    return encode_added


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a document of n ids."""
    first = n % capacity or min(n, capacity)
    edges = [0, *range(first, n + 1, capacity)]
    return list(zip(edges, edges[1:]))


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def token_pieces(df: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
                 tokenizer: str | None = None, added_tokens: bool = False) -> DataFrame:
    """Pieces of all documents; nth counts the task's pieces of that length."""
    names = [x.split()[0] for x in PIECES.split(", ")]
    kinds = [pa.int32() if n in ("piece", "task") else pa.int64() for n in names]

    def pieces(batches):
        from pyspark import TaskContext
        task, seen, encode = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64), None
        for batch in batches:
            encode = encode or encoder(tokenizer, added_tokens)
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                for k, (a, b) in enumerate(cut(len(ids), capacity)):
                    rows.append((doc, k, a, b - a, zlib.crc32(ids[a:b]), task, seen[b - a]))
                    seen[b - a] += 1
            cols = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pieces, PIECES)


PACKED = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
          "sequence_id long, offset long")


def pack(df: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
         tokenizer: str | None = None, added_tokens: bool = False) -> DataFrame:
    """One row per piece: where it comes from and where it lies."""
    spark = df.sparkSession
    cuts = staged(token_pieces(df, capacity, end_id, tokenizer, added_tokens), "pieces")
    per_task = cuts.groupBy("task", "length").agg(F.count("*").alias("n"))
    # one row per (task, length): a length has at most as many rows as there are tasks
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = staged(per_task.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "ranks")
    counts = {r["length"]: r["n"]  # at most `capacity` rows
              for r in base.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    moves, _ = best_fit_moves(counts, capacity)
    table = np.array(moves, dtype=np.int64).reshape(-1, 5)
    plan = spark.sparkContext.broadcast(table)
    ranked = join_by_size(cuts, base.drop("n"), ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("base") + F.col("nth")).alias("rank"))

    def place(batches):
        length, rank, per, first, offset = plan.value.T
        keys = ((capacity - length) << 44) + rank
        for batch in batches:
            n, r = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            m = np.searchsorted(keys, ((capacity - n) << 44) + r, side="right") - 1
            nth = r - rank[m]
            bins = pa.array(first[m] + nth // per[m])
            at = pa.array(offset[m] + nth % per[m] * n)
            kept = [batch.column(c) for c in range(5)]
            yield pa.RecordBatch.from_arrays([*kept, bins, at], names=[
                x.split()[0] for x in PACKED.split(", ")])

    return ranked.mapInArrow(place, PACKED)


def op3_packing(spark, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir, "doc_id", "text"), added_tokens=True)
