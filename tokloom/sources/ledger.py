"""Stage ledger (K8): finished stages are found again by what they were made of.

A stage's folder carries a digest of its inputs' rows and of its parameters
in its name, and a manifest written after its data.  A stage is skipped only
when a manifest of the same digest is there: a changed row or parameter
gives another folder, and a stage that died has no manifest and runs anew.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokloom.session import checkpoint_dir, remove_tree


def table_digest(df: DataFrame) -> str:
    """Digest of a table's rows, whatever their order and partitions: their
    number and two sums of 64-bit row hashes.  One narrow pass."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    sums = df.select(*[F.xxhash64(F.lit(i), row).cast("decimal(38,0)").alias(f"h{i}") for i in (1, 2)]).agg(
        F.count(F.lit(1)).alias("n"), F.sum("h1").alias("a"), F.sum("h2").alias("b")).first()
    parts = [df.schema.json(), str(sums["n"]), str(sums["a"]), str(sums["b"])]
    return hashlib.sha256("|".join(parts).encode()).hexdigest()


def stage_path(spark: SparkSession, name: str, inputs: list[str], params: dict, root: str | None = None) -> str:
    """The folder of a stage with these input digests and parameters."""
    key = hashlib.sha256(json.dumps([name, inputs, params], sort_keys=True).encode()).hexdigest()[:24]
    return f"{(root or checkpoint_dir(spark)).rstrip('/')}/stages/{name}-{key}"


def is_done(spark: SparkSession, path: str) -> bool:
    """Whether the stage's manifest is there."""
    try:
        return not spark.read.schema("stage string").json(f"{path}/manifest").isEmpty()
    except AnalysisException:  # absent
        return False


def run_stage(spark: SparkSession, name: str, inputs: list[DataFrame], params: dict,
              build: Callable[[str], None], root: str | None = None) -> str:
    """The data folder of a stage, built by ``build(folder)`` unless a finished
    one of the same inputs and parameters is there."""
    digests = [table_digest(df) for df in inputs]
    path = stage_path(spark, name, digests, params, root)
    if not is_done(spark, path):
        remove_tree(spark, path)  # what a stage that died left
        build(f"{path}/data")
        note = {"stage": name, "inputs": digests, "params": json.dumps(params, sort_keys=True)}
        spark.createDataFrame([note], "stage string, inputs array<string>, params string").coalesce(1) \
            .write.json(f"{path}/manifest")
    return f"{path}/data"


def retain(spark: SparkSession, paths: DataFrame, keep: DataFrame) -> int:
    """K7: remove the folders of ``paths`` (path) that are not in ``keep``;
    how many there were.  Both are listings of stages, one row each."""
    gone = [r.path for r in paths.join(keep, "path", "left_anti").collect()]
    for path in gone:
        remove_tree(spark, path)
    return len(gone)
