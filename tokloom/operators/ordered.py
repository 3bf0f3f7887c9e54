"""Running sums over a global order without a single-task window.

A window without ``partitionBy`` moves every row into one task.  Instead:
range-partition on the order key, freeze the assignment with a reliable
checkpoint, total each partition, turn the (few) partition totals into
bases, and finish with a window *inside* each range partition.  Every task
holds one range partition; the only small table is one row per partition
(and group).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, MapType, StructField,
                               StructType)

from tokloom.session import cut_lineage, scratch

_PID = "_rp"


def running_sums(df: DataFrame, order: list, values: dict[str, Column],
                 group: list[str] = (), parts: int | None = None,
                 inclusive: bool = False) -> DataFrame:
    """Add, for each name in ``values``, the sum of that value over all
    earlier rows of the same group in ``order`` (current row included only
    when ``inclusive``).  ``order`` must be a total order inside a group.
    """
    group = list(group)
    keyed_by = {c for c in order if isinstance(c, str)}
    wide = any(isinstance(f.dataType, (ArrayType, MapType, BinaryType)) and f.name not in keyed_by
               for f in df.schema)
    if wide and not group and not inclusive:
        return _wide_running_sums(df, order, values, parts)
    return _running_sums(df, order, values, group, parts, inclusive)


def _wide_running_sums(df: DataFrame, order: list, values: dict[str, Column],
                       parts: int | None) -> DataFrame:
    """Running sums over wide rows (token arrays), which move once: they are
    range-partitioned and sorted by the order key, each task adds the sums
    inside its part and writes the rows; the parts' totals (one row each,
    broadcast) make the sums global.  What is returned reads the written
    table, so its consumers shuffle nothing again."""
    spark = df.sparkSession
    names = list(values)
    keys = {f"_o{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order)}
    rows = df.select("*", *[c.alias(k) for k, c in keys.items()],
                     *[v.cast("long").alias(f"_s_{k}") for k, v in values.items()])
    # the range sampler runs a job of its own: compute the rows once for both
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    ranged = (rows.repartitionByRange(parts, *keys) if parts else rows.repartitionByRange(*keys))
    ranged = ranged.sortWithinPartitions(*keys).drop(*keys)
    at = {k: ranged.columns.index(f"_s_{k}") for k in names}

    def add(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        so_far = dict.fromkeys(names, 0)
        for batch in batches:
            columns = list(batch.columns)
            for k in names:
                sizes = columns[at[k]].fill_null(0).to_numpy().astype(np.int64)
                upto = np.cumsum(sizes)
                columns[at[k]] = pa.array(upto - sizes + so_far[k])
                so_far[k] += int(upto[-1]) if len(upto) else 0
                columns.append(pa.array(sizes))
            columns.append(pa.array(np.full(batch.num_rows, part, dtype=np.int32)))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    schema = StructType([*ranged.schema.fields, *[StructField(f"_n_{k}", LongType()) for k in names],
                         StructField(_PID, IntegerType())])
    path = scratch(spark, "ordered")
    ranged.mapInArrow(add, schema).write.parquet(path)
    rows.unpersist()
    table = spark.read.schema(schema).parquet(path)
    totals = table.groupBy(_PID).agg(*[F.sum(f"_n_{k}").alias(f"_t_{k}") for k in names])
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    base = totals.select(_PID, *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_b_{k}") for k in names])
    return table.join(F.broadcast(base), _PID).select(
        *df.columns, *[(F.col(f"_s_{k}") + F.col(f"_b_{k}")).alias(k) for k in names])


def _running_sums(df: DataFrame, order: list, values: dict[str, Column], group: list[str],
                  parts: int | None, inclusive: bool) -> DataFrame:
    vals = {f"_s_{k}": v for k, v in values.items()}
    # the range partitioner samples its input in a job of its own; keep the
    # input so that job and the checkpoint do not both recompute it
    src = df.select("*", *[v.alias(k) for k, v in vals.items()]).persist(
        StorageLevel.MEMORY_AND_DISK)
    # without an explicit count AQE may merge *adjacent* range partitions,
    # which keeps them ordered; the checkpoint then freezes the assignment
    ranged = (src.repartitionByRange(parts, *group, *order) if parts
              else src.repartitionByRange(*group, *order))
    keyed = ranged.withColumn(_PID, F.spark_partition_id())
    keyed = cut_lineage(keyed)
    src.unpersist()

    totals = keyed.groupBy(_PID, *group).agg(
        *[F.sum(k).alias(f"_t{k}") for k in vals])
    wt = (Window.partitionBy(*group).orderBy(_PID)
          .rowsBetween(Window.unboundedPreceding, -1))
    base = totals.select(
        _PID, *group,
        *[F.coalesce(F.sum(f"_t{k}").over(wt), F.lit(0)).alias(f"_b{k}") for k in vals])
    # one row per (range partition, group present in it): bounded by the
    # partition count plus the number of groups; broadcast when ungrouped.
    if not group:
        base = F.broadcast(base)
    joined = keyed.join(base, [_PID, *group])
    upper = Window.currentRow if inclusive else -1
    w = (Window.partitionBy(_PID, *group).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, upper))
    out = joined.select(
        "*", *[(F.col(f"_b{k}") + F.coalesce(F.sum(k).over(w), F.lit(0))).alias(name)
               for name, k in zip(values, vals)])
    drop = [_PID, *vals, *[f"_b{k}" for k in vals]]
    return out.drop(*drop)
