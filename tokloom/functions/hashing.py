"""Portable deterministic randomness.

``phash`` is the first 32 bits of md5 over the '|'-joined key parts.  It
gives the same value in Spark and in any SQL engine with md5, at any
partitioning, so shuffles, FIM cut points and sampling are reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def phash(*parts) -> Column:
    """Unsigned 32-bit hash of ``concat_ws('|', parts)`` as BIGINT."""
    joined = F.concat_ws("|", *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("bigint")


def uniform(*parts) -> Column:
    """Uniform double in [0, 1)."""
    return phash(*parts) / F.lit(TWO_32)


def uniform_int(lo, hi, *parts) -> Column:
    """Uniform integer in [lo, hi] (inclusive); lo/hi may be columns."""
    lo_c, hi_c = _c(lo), _c(hi)
    return (lo_c + F.pmod(phash(*parts), hi_c - lo_c + F.lit(1))).cast("int")


def word_hash_id(word: Column, base: int, span: int) -> Column:
    """Token id of a word under the word-hash tokenizer."""
    h = F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint")
    return (F.lit(base) + F.pmod(h, F.lit(span))).cast("int")
