"""Encoding and decoding with a learned BPE model (T3, T3b, T3c, T3d, J2, J3).

The model (bounded by the vocabulary size) is broadcast and every document
is encoded in the task that holds it, a slice at a time: its words are found and made
distinct by array operations, distinct words are cut where no merge joins two
bytes, and only pieces the task has not met are merged.  Nothing is shuffled
and ids stay with their row; decoding is the same in reverse.
"""

from __future__ import annotations

import heapq
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokloom.functions.bytelevel import CHAR_TO_BYTE, byte_ids
from tokloom.functions.text import py_strip
from tokloom.operators.bpe import PIECE_CHARS, BpeModel, text_pieces
from tokloom.operators.words import char_classes, slices, words_of


def merge_word(ids: list[int], ranks: dict) -> list[int]:
    """Apply merges to one word: repeatedly merge the adjacent pair of
    lowest rank (leftmost first), exactly like a rank-ordered heap."""
    syms = list(ids)
    if len(syms) < 2:
        return syms
    heap = [(ranks[(syms[i], syms[i + 1])][0], i)
            for i in range(len(syms) - 1) if (syms[i], syms[i + 1]) in ranks]
    if not heap:
        return syms
    # linked list over positions; a merged-away slot has length 0
    nxt = list(range(1, len(syms))) + [-1]
    prv = [-1] + list(range(len(syms) - 1))
    alive = [True] * len(syms)
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        if not alive[i] or nxt[i] < 0:
            continue
        j = nxt[i]
        pair = (syms[i], syms[j])
        hit = ranks.get(pair)
        if hit is None or hit[0] != rank:
            continue
        syms[i] = hit[1]
        alive[j] = False
        nxt[i] = nxt[j]
        if nxt[j] >= 0:
            prv[nxt[j]] = i
        if prv[i] >= 0:
            p = prv[i]
            h = ranks.get((syms[p], syms[i]))
            if h is not None:
                heapq.heappush(heap, (h[0], p))
        if nxt[i] >= 0:
            h = ranks.get((syms[i], syms[nxt[i]]))
            if h is not None:
                heapq.heappush(heap, (h[0], i))
    return [s for s, a in zip(syms, alive) if a]


#: Pieces of words a task remembers before it starts afresh.
KNOWN_WORDS = 500_000


def _ranks(model: BpeModel) -> dict:
    ranks: dict = {}
    for r, (a, b, m) in enumerate(model.merges):
        ranks.setdefault((a, b), (r, m))
    return ranks


def _joins(model: BpeModel) -> np.ndarray:
    """Whether some merge joins a byte (256 times its value) and the next one:
    words are cut between the others, and the pieces merge alone."""
    joins = np.zeros(1 << 16, dtype=bool)
    for a, b, _ in model.merges:
        joins[CHAR_TO_BYTE[model.tokens[a][-1]] << 8 | CHAR_TO_BYTE[model.tokens[b][0]]] = True
    return joins


def _spread(flat: np.ndarray, edges: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the lists of ``flat`` between ``edges`` that ``at`` names, end to end;
    their edges)."""
    size = np.diff(edges)[at]
    out = np.concatenate([[0], np.cumsum(size)])
    return flat[np.repeat(edges[at] - out[:-1], size) + np.arange(out[-1])], out


def _word_ids(words: pa.Array, table: np.ndarray, joins: np.ndarray, ranks: dict, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """(ids of the words end to end, edges of the words).  Distinct words are cut
    into pieces and distinct pieces of two bytes or more are merged, unless the
    task remembers them."""
    coded = words.dictionary_encode()
    distinct = coded.dictionary
    off = np.frombuffer(distinct.buffers()[1], dtype=np.int32)[:len(distinct) + 1]
    raw = np.frombuffer(distinct.buffers()[2], dtype=np.uint8)[:off[-1]]
    joined = np.zeros(len(raw), dtype=bool)
    joined[:-1] = joins[raw[:-1].astype(np.uint16) << 8 | raw[1:]]
    joined[off[1:] - 1] = False
    end = np.flatnonzero(~joined) + 1
    start = np.concatenate([[0], end[:-1]])
    long = np.flatnonzero(end - start > 1)
    pieces = pa.Array.from_buffers(pa.binary(), len(end), [None, pa.py_buffer(np.concatenate([[0], end]).astype(np.int32)),
                                                           pa.py_buffer(raw)]).take(pa.array(long)).dictionary_encode()
    merged = []
    for p in pieces.dictionary.to_pylist():
        ids = known.get(p)
        if ids is None:
            if len(known) >= KNOWN_WORDS:
                known.clear()
            ids = known[p] = merge_word(table[np.frombuffer(p, dtype=np.uint8)].tolist(), ranks)
        merged.append(ids)
    size = np.fromiter(map(len, merged), dtype=np.int64, count=len(merged))
    flat = np.fromiter(chain.from_iterable(merged), dtype=np.int32, count=int(size.sum()))
    flat, edges = _spread(flat, np.concatenate([[0], np.cumsum(size)]), pieces.indices.to_numpy())
    size = np.ones(len(end), dtype=np.int64)
    size[long] = np.diff(edges)
    upto = np.concatenate([[0], np.cumsum(size)])
    ids = np.empty(upto[-1], dtype=np.int32)
    ids[upto[:-1]] = table[raw[start]]
    ids[np.repeat(upto[long] - edges[:-1], size[long]) + np.arange(edges[-1])] = flat
    of_word = upto[np.concatenate([[0], np.searchsorted(end, off[1:]) + 1])]
    return _spread(ids, of_word, coded.indices.to_numpy())


def encode_docs(docs: DataFrame, model: BpeModel, key: str = "doc_id",
                text_col: str = "text", strip: bool = True, keep: tuple = ()) -> DataFrame:
    """(key, *keep, ids) per document; no bos/eos.  Blank documents vanish."""
    cols = [key, *keep]
    texts = docs.select(*cols, F.col(text_col).cast("string").alias("_t"))
    spark = docs.sparkSession
    classes = char_classes(spark)
    shared = spark.sparkContext.broadcast((byte_ids(model.n_special), _ranks(model), _joins(model)))

    def encode(batches):
        table, ranks, joins = shared.value
        table = np.array(table, dtype=np.int32)
        known: dict = {}
        for batch in batches:
            for row, n, data, rows, edges in slices(batch.column("_t"), strip):
                ids, upto, so_far = [np.zeros(0, np.int32)], np.zeros(n + 1, np.int64), 0
                for low, words in words_of(data, edges, classes):
                    if len(words):
                        part, of_word = _word_ids(words, table, joins, ranks, known)
                        begins = np.frombuffer(words.buffers()[1], dtype=np.int32)
                        here = (rows > low) & (rows <= low + begins[-1])
                        upto[here] = so_far + of_word[np.searchsorted(begins, rows[here] - low)]
                        ids.append(part)
                        so_far += len(part)
                size = np.diff(np.maximum.accumulate(upto))
                some = np.flatnonzero(size)
                if len(some):
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size[some])]).astype(np.int32)),
                                                     pa.array(np.concatenate(ids)))
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(some + row)) for c in cols), lists],
                                                     names=[*cols, "ids"])
        pa.default_memory_pool().release_unused()  # the worker stays

    schema = T.StructType([*texts.select(*cols).schema.fields,
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return texts.mapInArrow(encode, schema)


def encode_pieces(docs: DataFrame, model: BpeModel, key: str = "doc_id", text_col: str = "text",
                  piece_chars: int = PIECE_CHARS, strip: bool = True) -> DataFrame:
    """T3 for very long documents: (key, piece, ids), the ids of a document
    being those of its pieces in order.  Pieces are dealt evenly over the
    tasks, so one document is encoded by many."""
    t = py_strip(text_col) if strip else F.col(text_col)
    pieces = docs.select(key, t.alias("_t")).select(
        key, F.posexplode(text_pieces("_t", piece_chars)).alias("piece", "_p"))
    dealt = pieces.repartition(key, "piece")
    return encode_docs(dealt, model, key, "_p", strip=False, keep=("piece",))


def decode_ids(seqs: DataFrame, vocab: DataFrame, key: str = "doc_id",
               ids_col: str = "ids", skip_special: bool = True) -> DataFrame:
    """Ids back to text.  The vocabulary (id, hex, is_special; bounded by
    its size) is collected once and broadcast; the bytes of a row's tokens
    are joined and decoded as UTF-8 (bad sequences -> U+FFFD).  NUL and every
    other byte survive because no character mapping is used."""
    rows = vocab.select("id", "hex", "is_special").collect()
    table = {r["id"]: bytes.fromhex(r["hex"]) for r in rows if r["hex"] is not None}
    if not skip_special:
        names = {r["id"]: r["token"] for r in vocab.where("is_special").collect()}
        table.update({i: t.encode() for i, t in names.items()})
    shared = seqs.sparkSession.sparkContext.broadcast(table)

    def decode(batches):
        token = shared.value
        for batch in batches:
            texts = [b"".join(token.get(i, b"") for i in ids or ()).decode("utf-8", "replace")
                     for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(texts, pa.string())],
                                             names=[key, "text"])

    schema = T.StructType([seqs.schema[key], T.StructField("text", T.StringType())])
    return seqs.select(key, ids_col).mapInArrow(decode, schema)


def add_template(ids: Column, bos: int, eos: int, pair: Column | None = None) -> Column:
    """<bos> A <eos> (and B <eos> for a pair)."""
    out = F.concat(F.array(F.lit(bos)), ids, F.array(F.lit(eos)))
    if pair is not None:
        out = F.concat(out, pair, F.array(F.lit(eos)))
    return out


def assemble(ids: Column, tag_id: Column, eot_id: int) -> Column:
    """T3d: [tag?] + ids + [eot]."""
    tag = F.when(tag_id.isNotNull(), F.array(tag_id.cast("int"))).otherwise(
        F.array().cast("array<int>"))
    return F.concat(tag, ids, F.array(F.lit(eot_id)))


def prompt_ids(prompt: Column, encoded: Column, bos: int, eos: int) -> Column:
    """A blank prompt is the single id <bos>; otherwise the template."""
    return F.when(F.length(py_strip(prompt)) == 0, F.array(F.lit(bos))).otherwise(
        add_template(encoded, bos, eos))


def new_tokens(ids: Column, prompt_len: Column) -> Column:
    """The ids generated after the prompt."""
    return F.slice(ids, prompt_len + 1, F.greatest(F.size(ids) - prompt_len, F.lit(0)))
