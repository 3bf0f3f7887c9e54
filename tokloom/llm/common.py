"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokloom.session import checkpoint_dir

#: A word: a longest run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: A side is broadcast only when its counted rows are at most this many
#: (rows of the tables concerned are narrow: under 100 bytes).
BROADCAST_ROWS = 100_000

#: Words a task remembers before it starts afresh.
KNOWN_WORDS = 50_000


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*cols) if cols else df


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet into the cluster's shared checkpoint folder
    and read back: lineage ends here, lost executors read it again, and
    every consumer sees the same rows."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tokloom-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_by_size(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with ``small`` (cheap to count, e.g. staged): broadcast when its
    counted rows are within BROADCAST_ROWS, else an ordinary shuffle join
    (adaptive execution splits skewed keys)."""
    if small.count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    return big.join(small, on, how)


def one_by_one(column: pa.Array) -> Iterator:
    """Values of a column; those of a batch never exist together in Python."""
    return (x.as_py() for x in column)


def give_back() -> None:
    """At the end of a task: workers are used again for other stages, so what
    allocators hold but do not use goes back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def row_key(doc_id: Column, text: Column) -> Column:
    """128-bit content key of a row as a hex string: equal for repeated rows
    (same id and text), also when the id is null."""
    return F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("null")),
                             F.md5(F.coalesce(text, F.lit("")))))


def id_crc32(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")))
