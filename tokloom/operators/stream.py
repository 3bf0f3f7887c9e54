"""Token stream layout.

The stream is never one array: it is ``(key, start_off, ids)`` per document
with global offsets from a two-pass prefix sum.  Fixed-size blocks are cut
from it by the tasks that hold its stretches, each block with the ids that
follow it; only blocks over the edge of a stretch are regrouped by block
number.  A window needs at most its own block and the ids ahead of it.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokloom.config import HASH_ID_BASE, HASH_ID_SPAN, HASH_WORD_RE
from tokloom.functions.hashing import uniform, word_hash_id
from tokloom.functions.text import py_strip
from tokloom.operators.ordered import running_sums


def hash_token_ids(text: Column) -> Column:
    """Word-hash tokenizer: one id per whitespace-delimited word."""
    return F.transform(F.regexp_extract_all(text, F.lit(HASH_WORD_RE), 0),
                       lambda w: word_hash_id(w, HASH_ID_BASE, HASH_ID_SPAN))


def hash_tokenize(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, ids) with the word-hash tokenizer over stripped, non-blank text."""
    t = py_strip(text_col)
    return (docs.select("*", t.alias("_t")).where(F.length("_t") > 0)
            .withColumn("ids", hash_token_ids(F.col("_t"))).drop("_t"))


def stream_offsets(docs: DataFrame, order: list, ids_col: str = "ids") -> DataFrame:
    """Global start offset of each document in ``order``."""
    return running_sums(docs, order, {"start_off": F.size(ids_col).cast("long")})


def total_tokens(stream: DataFrame, ids_col: str = "ids") -> int:
    """A3: one number to the driver."""
    return int(stream.agg(F.coalesce(F.sum(F.size(ids_col)), F.lit(0))).first()[0])


def split_sizes(total: int, val_ratio: float) -> tuple[int, int, float]:
    """T5 arithmetic: ratio clamped to [0, 0.5]; at least one val token."""
    r = max(0.0, min(val_ratio, 0.5))
    n_val = max(1, int(total * r))
    return total - n_val, n_val, r


def split_tail(stream: DataFrame, total: int, val_ratio: float,
               key: str = "doc_id") -> DataFrame:
    """T5 (tail): the last n_val tokens of the ordered stream are val; a
    document straddling the cut is sliced.  Output: split, key, start_off
    (offset inside its split), ids."""
    n_train, _, _ = split_sizes(total, val_ratio)
    st, n = F.col("start_off"), F.size("ids")
    k_train = F.least(F.greatest(F.lit(n_train) - st, F.lit(0)), n)
    train = stream.where(k_train > 0).select(
        F.lit("train").alias("split"), key, st.alias("start_off"),
        F.slice("ids", 1, k_train).alias("ids"))
    val = stream.where(k_train < n).select(
        F.lit("val").alias("split"), key,
        (st + k_train - F.lit(n_train)).alias("start_off"),
        F.slice("ids", k_train + 1, n - k_train).alias("ids"))
    return train.unionByName(val)


def split_hash(docs: DataFrame, val_ratio: float, seed: int,
               key: str = "doc_id") -> DataFrame:
    """T5 (hash): whole documents go to val with probability ``val_ratio``."""
    return docs.withColumn(
        "split", F.when(uniform(seed, F.col(key)) < val_ratio, "val").otherwise("train"))


#: Ids that a task hands on at a time.
OUT_IDS = 1 << 20


def _ragged(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.ListArray:
    """The slices of ``values`` as lists; bounds outside it are cut."""
    start = np.clip(start, 0, len(values))
    size = np.maximum(np.clip(end, 0, len(values)) - start, 0)
    edges = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(start - edges[:-1], size) + np.arange(edges[-1])
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(values[at].astype(np.int32)))


def _stretches(batches):
    """(position, ids, whether the stretch ends here) of rows (start_off, ids) as
    they come: consecutive rows are joined while each begins where the one
    before it ended.  The position is that of the first id of the part."""
    at = None
    for batch in batches:
        start = batch.column(0).to_numpy()
        lists = batch.column(1)
        size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        flat, edges = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(size)])
        if not len(start):
            continue
        runs = np.flatnonzero(np.concatenate([[True], start[1:] != start[:-1] + size[:-1]]))
        for low, high in zip(runs, [*runs[1:], len(start)]):
            if at is not None and start[low] != at:
                yield at, flat[:0], True
            yield int(start[low]), flat[edges[low]:edges[high]], False
            at = int(start[low] + edges[high] - edges[low])
    if at is not None:
        yield at, np.zeros(0, np.int32), True


def blocks(stream: DataFrame, block_size: int, ahead: int | None = None) -> DataFrame:
    """Cut the ordered stream into blocks of ``block_size`` ids: (blk, at, ids,
    ahead), ``at`` the position of the first id and ``ahead`` the ids that
    follow the block (so many at most; as many as a block has by default).
    The last block may be short.

    A task cuts the blocks inside the stretches of the stream that it holds;
    what lies over an edge of a stretch is handed on in parts and regrouped by
    block number.  Rows out of order only make more stretches."""
    B, more = block_size, block_size if ahead is None else ahead
    rows = stream.where((F.size("ids") > 0) & F.col("start_off").isNotNull()).select(F.col("start_off").cast("long"), F.col("ids").cast("array<int>"))

    def cut(whole):
        def run(batches):
            first, held, base, blk = None, np.zeros(0, np.int32), 0, 0
            for at, ids, ends in _stretches(batches):
                if first is None:
                    first, base, held = at, at, ids
                    blk = max(0, (at - more) // B)
                else:
                    held = np.concatenate([held, ids])
                top = base + len(held)
                stop = -(-top // B) if ends else (top - more) // B
                while blk < stop:
                    upto = min(stop, blk + max(1, OUT_IDS // (B + more)))
                    n = np.arange(blk, upto)
                    inside = (n * B >= first) & ((n + 1) * B + more <= top)
                    n = n[inside == whole]
                    low = n * B - base
                    if whole and len(n):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(n), _ragged(held, low, low + B), _ragged(held, low + B, low + B + more)],
                            names=["blk", "ids", "ahead"])
                    elif len(n):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(n), pa.array(np.maximum(n * B, base)), _ragged(held, low, low + B + more)],
                            names=["blk", "at", "ids"])
                    blk = upto
                if ends:
                    first = None
                else:
                    gone = max(0, min(blk * B - base, len(held)))
                    held, base = held[gone:], base + gone
        return run

    inner = rows.mapInArrow(cut(True), "blk long, ids array<int>, ahead array<int>")
    parts = rows.mapInArrow(cut(False), "blk long, at long, ids array<int>").where(F.size("ids") > 0)
    edge = parts.groupBy("blk").agg(F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("p")).select(
        "blk", F.col("p")[0]["at"].alias("_at"), F.flatten(F.transform("p", lambda z: z["ids"])).alias("_ids"))
    # a part may hold nothing but ids ahead of its block
    own = (F.col("blk") + 1) * F.lit(B) - F.col("_at")
    edge = edge.where(own > 0).select(
        "blk", F.slice("_ids", F.lit(1), own.cast("int")).alias("ids"),
        F.slice("_ids", own.cast("int") + 1, F.lit(more)).alias("ahead"))
    return inner.unionByName(edge).select("blk", (F.col("blk") * F.lit(B)).alias("at"), "ids", "ahead")


def windows_packed(blk: DataFrame, block_size: int) -> DataFrame:
    """T4, stride = block_size: x = block b, y = x shifted by one, whose
    last id is the first id ahead of the block.  floor((N - 1) / B) windows."""
    return blk.where((F.size("ids") == block_size) & (F.size("ahead") > 0)).select(
        F.col("blk").alias("win_id"), F.col("ids").alias("x"),
        F.concat(F.slice("ids", 2, block_size - 1), F.slice("ahead", 1, 1)).alias("y"))


def windows_strided(blk: DataFrame, block_size: int, stride: int, total: int) -> DataFrame:
    """T4 at any stride: windows start at 0, stride, 2*stride, ... while
    start + block_size < N.  Window ``i`` lies in block i div B and the ids
    ahead of it (B of them); only the starts that exist are exploded.  At a
    small stride every id is in many windows; to read some of them, see
    ``operators/positions.py``."""
    B = block_size
    cat = F.concat("ids", "ahead")
    base = F.col("blk") * F.lit(B)
    last_start = F.lit(total - B - 1)  # starts s with s + B < N
    first = F.ceil(base / F.lit(stride)) * F.lit(stride)
    hi = F.least(base + F.lit(B - 1), last_start)
    starts = F.when(first <= hi, F.sequence(first.cast("long"), hi.cast("long"),
                                            F.lit(stride).cast("long")))
    ex = blk.select(cat.alias("_cat"), base.alias("_base"),
                    F.explode(starts).alias("start"))
    off = (F.col("start") - F.col("_base")).cast("int")
    return ex.select(
        F.col("start").alias("win_id"),
        F.slice("_cat", off + 1, B).alias("x"),
        F.slice("_cat", off + 2, B).alias("y"))


def window_count(total: int, block_size: int, stride: int = 1) -> int:
    """Number of windows."""
    if stride == block_size:
        return max(0, (total - 1) // block_size)
    n = max(0, total - block_size)
    return (n + stride - 1) // stride


def batch_count(n_windows: int, batch_size: int, drop_last: bool) -> int:
    return n_windows // batch_size if drop_last else -(-n_windows // batch_size)


#: Rounds of the keyed permutation, and steps of its walk at most.
ROUNDS, WALK = 4, 64


def _hashes(key: str, r: int, values: np.ndarray, known: dict) -> np.ndarray:
    """``phash(key, r, value)`` of every value; each distinct one is hashed once."""
    distinct, at = np.unique(values, return_inverse=True)
    of = known.setdefault((key, r), {})
    out = np.empty(len(distinct), dtype=np.int64)
    for i, v in enumerate(distinct.tolist()):
        h = of.get(v)
        if h is None:
            if len(of) >= KNOWN_HASHES:
                of.clear()
            h = of[v] = int(hashlib.md5(f"{key}{r}|{v}".encode()).hexdigest()[:8], 16)
        out[i] = h
    return out[at]


#: Hashes of a round that a task remembers.
KNOWN_HASHES = 1 << 17


def permuted(x: Column, n: int, *key) -> Column:
    """The place of x in a keyed order of 0 ... n - 1, a bijection.

    x is a cell of a grid of a columns and b rows that holds n or a little
    more; in turn the column moves by a hash of the row and the row by a hash
    of the column.  Each move can be undone, so no two cells meet.  A cell
    beyond n moves on until it falls inside (at most as often as there are
    cells beyond n, about one in sqrt(n) of all).  A place depends on x alone:
    no sort, no exchange, no count of earlier rows.  There are as many hashes
    as rows and columns, not as samples."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    b = max(1, -(-n // a))
    steps = min(WALK, a * b - n + 1)
    known: dict = {}

    def move(cell, of):
        col, row = cell // b, np.fmod(cell, b)
        for r in range(ROUNDS):
            if r % 2 == 0:
                col = (col + _hashes(of, r, row, known)) % a
            else:
                row = (row + _hashes(of, r, col, known)) % b
        return col * b + row

    def places(cells, of):
        at = move(cells, of)
        for _ in range(steps):
            out = np.flatnonzero(at >= n)
            if not len(out):
                break
            at[out] = move(at[out], of)
        return at

    @F.arrow_udf("long")
    def place(xs: pa.Array, keys: pa.Array) -> pa.Array:
        cells, coded = pc.fill_null(xs, 0).to_numpy(), keys.dictionary_encode()
        at, which = np.zeros(len(cells), dtype=np.int64), coded.indices.to_numpy()
        for i, of in enumerate(coded.dictionary.to_pylist()):
            at[which == i] = places(cells[which == i], of)
        return pa.array(at, mask=xs.is_null().to_numpy(zero_copy_only=False))

    # evaluated once a row, wherever the place is used
    parts = [(p if isinstance(p, Column) else F.lit(p)).cast("string") for p in key]
    return place.asNondeterministic()(x.cast("long"), F.concat_ws("|", *parts, F.lit("")))


def shuffled_batches(samples: DataFrame, batch_size: int, seed: int,
                     n_samples: int, key: str = "win_id", drop_last: bool = True,
                     epoch: str | None = None) -> DataFrame:
    """O5 + T8 (train): samples numbered 0 ... n_samples - 1 by ``key`` are put
    into a keyed order, cut into batches of ``batch_size``; the last partial
    batch is dropped.  Batch and row follow from the number: rows stay where
    they are.

    ``n_samples`` (per epoch) is known from the window count, so nothing is
    counted here.  With an ``epoch`` column every epoch has its own order,
    its own batches and its own dropped rest; batch ids run on."""
    place = permuted(F.col(key), n_samples, seed, *([F.col(epoch)] if epoch else []))
    per_epoch = batch_count(n_samples, batch_size, drop_last)
    earlier = F.col(epoch) * F.lit(per_epoch) if epoch else F.lit(0)
    out = samples.withColumn("_rank", place)
    if drop_last:
        out = out.where(F.col("_rank") < per_epoch * batch_size)
    return out.withColumn("batch_id", (earlier + F.floor(F.col("_rank") / batch_size)).cast("long")) \
        .withColumn("row", (F.col("_rank") % batch_size).cast("int")).drop("_rank")


def sequential_batches(samples: DataFrame, batch_size: int, key: str = "win_id") -> DataFrame:
    """T8 (val): dense window ids in order; the last batch is kept."""
    return samples.withColumn("batch_id", F.floor(F.col(key) / batch_size)) \
        .withColumn("row", (F.col(key) % batch_size).cast("int"))


def epochs(samples: DataFrame, n_epochs: int) -> DataFrame:
    """The samples once for each epoch; the epoch joins the shuffle key
    and groups the batches (see shuffled_batches)."""
    return samples.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_epochs - 1)))
                          .alias("epoch"))
