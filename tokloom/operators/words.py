"""The pre-tokenizer (T1) over whole batches of texts.

``bpe.pretokenize`` is a regular expression that matches word by word.  Here
the same words are found for many texts at once by array operations on their
UTF-8 bytes: every byte has the class of its character (letter, number, white
space, other; the classes are those of the JVM's expression), and whether a
word begins at a byte follows from the bytes next to it.
"""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4

#: What Python's ``str.strip()`` removes (``config.PY_SPACE_CLASS``).
PY_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

#: Bytes of text that are cut into words at a time, and from which a text is cut.
SLICE_BYTES = 1 << 20

_classes: list[bytes] = []


def char_classes(spark: SparkSession) -> bytes:
    """Class of every code point, compressed; asked of Spark's expressions
    once a process."""
    if not _classes:
        chars = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        rows = [chars[i:i + 0x4000] for i in range(0, len(chars), 0x4000)]
        rules = {LETTER: (r"\p{L}", "a"), NUMBER: (r"\p{N}", "0"), SPACE: (r"\s", " ")}
        marked = spark.createDataFrame(pa.table({"i": range(len(rows)), "t": rows})).coalesce(1).select(
            "i", *[F.regexp_replace("t", f"(?U){rule}", mark).alias(f"c{cls}") for cls, (rule, mark) in rules.items()]).toArrow().sort_by("i")
        table = np.full(0x110000, OTHER, dtype=np.uint8)
        code = np.frombuffer(chars.encode("utf-32-le"), dtype=np.uint32)
        for cls, (_, mark) in rules.items():
            there = "".join(marked.column(f"c{cls}").to_pylist()).encode("utf-32-le")
            table[code[np.frombuffer(there, dtype=np.uint32) == ord(mark)]] = cls
        _classes.append(zlib.compress(table.tobytes()))
    return _classes[0]


@cache
def _tables(classes: bytes) -> tuple[np.ndarray, bytes]:
    """(class of every code point, class of every byte: 0 from 128 on)."""
    table = np.frombuffer(zlib.decompress(classes), dtype=np.uint8)
    return table, table[:128].tobytes() + bytes(128)


def word_starts(b: np.ndarray, edges: np.ndarray, classes: bytes) -> np.ndarray:
    """Places where words begin in the bytes ``b`` of texts that begin at
    ``edges`` (the last of which is the end); no word goes over an edge."""
    n = len(b)
    if not n:
        return np.zeros(0, np.int64)
    of_char, of_byte = _tables(classes)
    k = np.frombuffer(bytearray(b.tobytes().translate(of_byte)), dtype=np.uint8)
    lead = np.flatnonzero(b >= 0xC0)
    first = b[lead]
    blanks = []
    for size, low, high, bits in ((2, 0xC0, 0xE0, 0x1F), (3, 0xE0, 0xF0, 0x0F), (4, 0xF0, 0x100, 0x07)):
        at = lead[(first >= low) & (first < high)] if high < 0x100 else lead[first >= low]
        code = b[at].astype(np.int32) & bits
        for j in range(1, size):
            code = code << 6 | b[at + j] & 0x3F
        cls = of_char[code]
        for j in range(size):
            k[at + j] = cls
        blanks.append((size, at[cls == SPACE]))
    edge = np.zeros(n + 5, dtype=bool)
    edge[edges] = True
    space, joins = k == SPACE, b == 0x20
    begins = np.empty(n, dtype=bool)
    begins[0] = True
    # classes change, and no single space before goes with what follows it
    np.logical_and(k[1:] != k[:-1], ~joins[:-1], out=begins[1:])
    # the last of several white-space characters stands alone unless the text ends
    begins[1:-1] |= space[1:-1] & space[:-2] & ~space[2:]
    for size, at in blanks:
        for j in range(1, size):
            begins[at + j] = False
        at = at[(at > 0) & (at + size < n)]
        begins[at[space[at - 1] & ~space[at + size] & ~edge[at + size]]] = True
    last = edges[(edges > 1) & (edges < n)] - 1
    begins[last] = (k[last] != k[last - 1]) & ~joins[last - 1]
    begins[edges[edges < n]] = True
    # 's 't 'm 'd 're 've 'll where a word begins with the apostrophe
    mark = np.flatnonzero(b == 0x27)
    mark = mark[mark + 1 < n]
    mark = mark[begins[mark] & ~edge[mark + 1]]
    one = mark[np.isin(b[mark + 1], np.frombuffer(b"stmd", dtype=np.uint8))]
    two = mark[(mark + 2 < n) & ~edge[mark + 2]]
    pair = b[two + 1].astype(np.int32) << 8 | b[two + 2]
    two = two[np.isin(pair, [int.from_bytes(x, "big") for x in (b"re", b"ve", b"ll")])]
    for at, size in ((one, 2), (two, 3)):
        begins[at + 1] = False
        after = at[at + size < n] + size
        begins[after[k[after] == LETTER]] = True
    return np.flatnonzero(begins)


def _cut_long(data: np.ndarray, low: int, high: int, most: int) -> list[int]:
    """Places inside a long text where words begin whatever stands before:
    before a space that follows a letter or digit of ASCII, and ``most`` bytes
    or more apart."""
    found, at = [], low + most
    while at < high:
        near = data[at - 1:min(high, at + most)]
        plain = ((near | 0x20) >= 0x61) & ((near | 0x20) <= 0x7A) | (near >= 0x30) & (near <= 0x39)
        hit = np.flatnonzero(plain[:-1] & (near[1:] == 0x20))
        if len(hit):
            found.append(at + int(hit[0]))
            at = found[-1] + most
        else:
            at += most
    return found


def _whole(texts: pa.Array) -> pa.Array:
    """Texts as the JVM reads them: bad UTF-8 becomes U+FFFD, null is empty."""
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:
        texts = pa.array([None if x is None else x.decode("utf-8", "replace")
                          for x in texts.cast(pa.binary()).to_pylist()], pa.string())
    return pc.fill_null(texts.cast(pa.large_string()), "")


def slices(texts: pa.Array, strip: bool, most: int = SLICE_BYTES, piece: int = SLICE_BYTES):
    """(first row, rows, bytes, edges of the rows, edges of the texts' pieces) of
    consecutive rows of about ``most`` bytes, or one longer row; texts are
    stripped first if asked."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.concatenate([[0], np.cumsum(size)])
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(upto, upto[low] + most, side="right")) - 1)
        part = _whole(texts.slice(low, high - low))
        if strip:
            part = pc.utf8_trim(part, characters=PY_SPACE)
        off = np.frombuffer(part.buffers()[1], dtype=np.int64)[part.offset:part.offset + len(part) + 1]
        data = np.frombuffer(part.buffers()[2] or b"", dtype=np.uint8)
        cuts = [c for i in np.flatnonzero(np.diff(off) > piece) for c in _cut_long(data, int(off[i]), int(off[i + 1]), piece)]
        edges = np.union1d(off, np.array(cuts, dtype=np.int64)) - off[0]
        yield low, high - low, data[off[0]:off[-1]], off - off[0], edges
        low = high


def words_of(b: np.ndarray, edges: np.ndarray, classes: bytes, most: int = SLICE_BYTES):
    """(place of the first byte, words as a string array) of the pieces between
    ``edges``, so many that they have about ``most`` bytes at a time."""
    at = 0
    while at < len(edges) - 1:
        upto = max(at + 1, int(np.searchsorted(edges, edges[at] + most, side="right")) - 1)
        low, part = edges[at], b[edges[at]:edges[upto]]
        starts = word_starts(part, edges[at:upto + 1] - low, classes)
        off = np.concatenate([starts, [len(part)]]).astype(np.int32)
        yield int(low), pa.StringArray.from_buffers(len(starts), pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(part)))
        at = upto
