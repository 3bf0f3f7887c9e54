"""Connected components of an edge table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokloom.llm.common import staged


def connected_components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """(v, root) for every end of the edges (a, b): root is the smallest
    vertex reachable.  A round hooks each vertex to its smallest neighbour,
    jumps to that one's own target, and contracts the edges: those inside a
    group vanish, the others go on between groups, so the table shrinks from
    round to round; long chains halve and stars end at once.  The target side
    of each join holds a vertex once; edges come straight from their shuffle,
    so adaptive execution splits a vertex with very many.  A round's tables
    are written to the shared folder."""
    left = staged(edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    for _ in range(rounds):
        ends = left.select(F.col("a").alias("v"), F.col("a").alias("low")).union(
            left.select(F.col("b").alias("v"), F.col("a").alias("low")))
        hook = staged(ends.groupBy("v").agg(F.min("low").alias("low")), "hooks")
        far = hook.select(F.col("v").alias("low"), F.col("low").alias("to"))
        jump = staged(hook.join(far, "low").select("v", "to"), "jumps")
        labels = jump.withColumnRenamed("to", "root") if labels is None else staged(
            labels.join(jump.withColumnRenamed("v", "root"), "root", "left").select(
                "v", F.coalesce("to", "root").alias("root")), "roots")
        for end in ("a", "b"):
            left = left.join(jump.select(F.col("v").alias(end), F.col("to").alias("_t")), end).drop(end) \
                .withColumnRenamed("_t", end)
        left = staged(left.where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        if left.isEmpty():
            return labels
    raise RuntimeError("components did not settle")
