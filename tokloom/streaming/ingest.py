"""Incremental ingest (R1) and running per-language counts (R2).

The source is a file stream with a fixed schema.  Each micro-batch is
filtered and cut by the running quota, then written to its own
``epoch=<id>`` folder with overwrite, so a replayed epoch replaces its
earlier attempt instead of duplicating rows.  What each epoch wrote per group
(rows, bytes) goes into a small manifest table beside it; the sums so far go
into a snapshot.  The quota state of an epoch is the one snapshot before it,
so neither earlier output nor earlier manifests are read again, and a failed
read is an error, not an empty state.

The quota is by arrival: rows count in the order (epoch, ``order``).  It
equals the batch quota (W2) over the same files when that runs in the order
(place of the file, ``order``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokloom.operators.ordered import running_sums
from tokloom.session import remove_tree, scratch


def _state_before(spark, state, epoch):
    """Rows and bytes of each group up to the epoch: one snapshot, however
    many epochs there were."""
    return spark.read.parquet(f"{state}/epoch={epoch - 1}") if epoch else None


def _snapshot(spark, state, epoch, wrote, prior, group):
    """Write the state after this epoch.  The snapshot before it stays, so the
    epoch can be replayed; older ones go."""
    added = wrote if prior is None else wrote.unionByName(prior)
    added.groupBy(*group).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes")) \
        .write.mode("overwrite").parquet(f"{state}/epoch={epoch}")
    if epoch > 1:
        remove_tree(spark, f"{state}/epoch={epoch - 2}")


def ingest_available_now(spark: SparkSession, src_dir: str, schema, transform,
                         order: list[str], size_col: str, group: list[str],
                         max_files: int | None = None, max_bytes: int | None = None,
                         glob: str = "*.parquet", files_per_trigger: int | None = 1,
                         dst: str | None = None) -> str:
    """Run the ingest to completion (availableNow) and return the
    sink path.  ``transform`` maps a raw micro-batch to the rows to keep
    (P1-P9); the quota (W2) then applies per ``group``.  Without
    ``files_per_trigger`` all files that are there are one epoch."""
    dst = dst or scratch(spark, "ingest")
    ckpt = dst + "/_checkpoint"
    data, manifest, state = dst + "/data", dst + "/manifest", dst + "/state"

    def write_batch(df: DataFrame, epoch: int):
        rows = transform(df)
        before = _state_before(spark, state, epoch)
        prior = before.withColumnsRenamed({"n_rows": "_pf", "n_bytes": "_pb"}) if epoch else None
        ranked = running_sums(rows, order, {"_fb": F.lit(1).cast("long"),
                                            "_bb": F.col(size_col).cast("long")},
                              group=group)
        if prior is not None:
            if group:
                # one row per group already written; an equi-join, so AQE
                # picks broadcast only from the measured size
                ranked = ranked.join(prior, group, "left")
            else:
                row = prior.first()
                ranked = ranked.withColumn("_pf", F.lit(row["_pf"] or 0)) \
                    .withColumn("_pb", F.lit(row["_pb"] or 0))
            ranked = ranked.withColumn("_fb", F.col("_fb") + F.coalesce("_pf", F.lit(0))) \
                .withColumn("_bb", F.col("_bb") + F.coalesce("_pb", F.lit(0))) \
                .drop("_pf", "_pb")
        cond = F.lit(True)
        if max_files:
            cond = cond & (F.col("_fb") < max_files)
        if max_bytes:
            cond = cond & (F.col("_bb") < max_bytes)
        out = ranked.where(cond).drop("_fb", "_bb")
        out.write.mode("overwrite").parquet(f"{data}/epoch={epoch}")
        wrote = spark.read.schema(out.schema).parquet(f"{data}/epoch={epoch}").groupBy(*group).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(size_col).cast("long").alias("n_bytes"))
        wrote.write.mode("overwrite").parquet(f"{manifest}/epoch={epoch}")
        _snapshot(spark, state, epoch, spark.read.schema(wrote.schema).parquet(f"{manifest}/epoch={epoch}"),
                  before, group)

    source = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_trigger:
        source = source.option("maxFilesPerTrigger", files_per_trigger)
    q = (source.parquet(src_dir)
         .writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", ckpt)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return data


def streaming_counts(spark: SparkSession, src_dir: str, schema, transform,
                     group: list[str], size_col: str, glob: str = "*.parquet",
                     dst: str | None = None) -> str:
    """R2: running rows and bytes per group while ingesting (complete
    mode; each trigger overwrites the small per-group table)."""
    dst = dst or scratch(spark, "counts")
    agg = (transform(spark.readStream.schema(schema).option("pathGlobFilter", glob)
                     .parquet(src_dir))
           .groupBy(*group)
           .agg(F.count(F.lit(1)).cast("long").alias("n_rows"),
                F.sum(size_col).cast("long").alias("n_bytes")))

    def write_batch(df: DataFrame, epoch: int):
        df.write.mode("overwrite").parquet(dst + "/data")

    q = (agg.writeStream.outputMode("complete").foreachBatch(write_batch)
         .option("checkpointLocation", dst + "/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return dst + "/data"
