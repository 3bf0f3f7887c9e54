"""Token shards by position.

Shards are written in stream order, so every file holds one stretch of a
split.  Ids are packed: little-endian, in two bytes while the vocabulary
allows it, else in four.  A sparse index (one row per file: its first and
last offset) tells which files a window lies in; windows stay (start, length)
until they are read, and only the files and blocks that requested windows
touch are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokloom.operators.stream import blocks


def id_bytes(vocab_size: int) -> int:
    """Bytes of a stored id."""
    return 2 if vocab_size < 1 << 16 else 4


def pack_ids(ids: Column, width: int) -> Column:
    """An array of ids as little-endian binary of ``width`` bytes each."""
    @F.arrow_udf("binary")
    def pack(lists: pa.Array) -> pa.Array:
        flat = lists.flatten().to_numpy().astype(f"<u{width}")
        edges = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())]) * width
        out = pa.Array.from_buffers(pa.binary(), len(lists), [
            None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(flat.tobytes())])
        return pc.if_else(lists.is_valid(), out, None)

    return pack(ids)


def unpack_ids(packed: Column, width: int) -> Column:
    """The ids of packed binary."""
    @F.arrow_udf("array<int>")
    def unpack(packs: pa.Array) -> pa.Array:
        flat = np.frombuffer(b"".join(x or b"" for x in packs.to_pylist()), dtype=f"<u{width}").astype(np.int32)
        edges = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(packs), 0).to_numpy())]) // width
        return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(flat),
                                        mask=None if not packs.null_count else packs.is_null())

    return unpack(packed)


def write_packed_shards(split_stream: DataFrame, out: str, vocab_size: int, mode: str = "overwrite") -> None:
    """K2: one folder per split, files in stream order, packed ids."""
    packed = split_stream.withColumn("n_tokens", F.size("ids").cast("long")) \
        .withColumn("ids", pack_ids(F.col("ids"), id_bytes(vocab_size)))
    (packed.repartitionByRange("split", "start_off").sortWithinPartitions("split", "start_off")
     .write.mode(mode).partitionBy("split").parquet(out))


def read_packed_shards(spark: SparkSession, path: str, vocab_size: int) -> DataFrame:
    df = spark.read.parquet(path)
    return df.withColumn("ids", unpack_ids(F.col("ids"), id_bytes(vocab_size)))


def shard_index(spark: SparkSession, path: str) -> DataFrame:
    """(split, file, first, last): the stretch of offsets of every file; only
    the two narrow columns are read."""
    return (spark.read.parquet(path).groupBy("split", F.col("_metadata.file_path").alias("file"))
            .agg(F.min("start_off").alias("first"), F.max(F.col("start_off") + F.col("n_tokens")).alias("last")))


def window_starts(spark: SparkSession, total: int, block_size: int, stride: int = 1) -> DataFrame:
    """T4: every window as (start, length); nothing is read."""
    return spark.range(0, max(0, total - block_size), stride).select(
        F.col("id").alias("start"), F.lit(block_size).alias("length"))


def read_windows(spark: SparkSession, path: str, split: str, starts: DataFrame, block_size: int,
                 vocab_size: int) -> tuple[DataFrame, list[str]]:
    """(start, x, y) of the requested windows of one split, and the files that
    were opened.  Requests beyond the split's last window have no row."""
    index = sorted((r["first"], r["last"], r["file"])
                   for r in shard_index(spark, path).where(F.col("split") == split).collect())  # a row per file
    first = np.array([r[0] for r in index], dtype=np.int64)
    last = np.array([r[1] for r in index], dtype=np.int64)

    def files_of(batches):
        for batch in batches:
            s = batch.column(0).to_numpy()
            low = s // block_size * block_size  # whole blocks are cut
            a = np.searchsorted(last, low, side="right")
            b = np.searchsorted(first, low + 2 * block_size, side="left")
            hit = np.unique(np.concatenate([np.arange(x, y) for x, y in set(zip(a.tolist(), b.tolist()))]
                                           or [np.zeros(0, np.int64)]))
            yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32))], names=["at"])

    starts = starts.select(F.col("start").cast("long").alias("start")).distinct()
    wanted = [index[r["at"]][2] for r in starts.mapInArrow(files_of, "at int").distinct().collect()]
    empty = spark.createDataFrame([], "start long, x array<int>, y array<int>")
    if not wanted:
        return empty, []
    asked = starts.select("start", F.floor(F.col("start") / block_size).alias("blk"))
    docs = spark.read.option("basePath", path).parquet(*wanted).select(
        "start_off", unpack_ids(F.col("ids"), id_bytes(vocab_size)).alias("ids"))
    cut = blocks(docs, block_size).select("blk", F.concat("ids", "ahead").alias("ids"))
    out = asked.join(cut, "blk").withColumn("at", (F.col("start") % block_size).cast("int")).where(
        F.size("ids") > F.col("at") + block_size)
    return out.select("start", F.slice("ids", F.col("at") + 1, F.lit(block_size)).alias("x"),
                      F.slice("ids", F.col("at") + 2, F.lit(block_size)).alias("y")), sorted(wanted)
