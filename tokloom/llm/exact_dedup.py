"""Exact dedup by deterministic block naming.

Every text is cut into blocks of ``block`` bytes.  The distinct blocks are
sorted and numbered: equal blocks, and only they, share an integer name.
Adjacent names are then paired (2i, 2i+1) and the distinct pairs are sorted
and numbered again, until one name per document is left after
ceil(log2(blocks)) rounds.  Two texts are equal exactly when they finish in
the same round with the same name: names are never hashes, so the identity
is free of collisions.

Numbers are dealt without a global sort: distinct keys are hash-partitioned
and sorted inside each partition, a name is the partition's number followed
by the place in it.  The table of names is written to the shared folder and
joined back to the occurrences; as both sides of that join come straight
from their shuffles, adaptive execution splits the side of a block that many
documents share.  Only the distinct blocks travel as text: the occurrences
look their name up by a digest, after a check over all distinct blocks that
the digest tells them apart (else the next longer digest is taken, and
without one the operator fails rather than guess).  DataFrame functions only.

Defined cases: a null text counts as empty and equals the empty text (one
empty block); of equal texts the row with the largest id stays, a null id
counts as the smallest; of repeated rows with that id exactly one stays;
an empty table gives no rows; columns other than the two named are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokloom.llm.common import documents, staged

BLOCK = 4096


#: Digests of a block, tried in turn.
DIGESTS = (F.md5, lambda c: F.sha2(c, 256), lambda c: F.sha2(c, 512))


def _named(distinct: DataFrame, keys: list[str]) -> DataFrame:
    return (distinct.sortWithinPartitions(*keys)
            .withColumn("name", F.monotonically_increasing_id()))


def _block_names(blocks: DataFrame):
    """(names, digest): a table (h, name) of the distinct blocks and the
    digest that proved to be one to one on them."""
    for digest in DIGESTS:
        names = staged(_named(blocks.select("blk").distinct(), ["blk"])
                       .select(digest(F.col("blk")).alias("h"), "name"), "names")
        if names.groupBy("h").count().where("count > 1").isEmpty():
            return names, digest
    raise ValueError("no digest tells all distinct blocks apart")


def name_texts(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
               block: int = BLOCK) -> DataFrame:
    """One row per input row: rid (the row's number in this result), doc_id,
    n_bytes, text_sha256, level and name; equal (level, name) means equal
    texts and the other way round."""
    t = F.coalesce(F.col(text), F.lit(""))
    base = df.select(F.col(doc_id).alias("doc_id"), t.alias("t"))
    base = base.select(F.monotonically_increasing_id().alias("rid"), "doc_id",
                       F.octet_length("t").alias("n_bytes"), F.sha2("t", 256).alias("sha"),
                       F.col("t").cast("binary").alias("bytes"))
    n_blocks = F.greatest(F.ceil(F.col("n_bytes") / block), F.lit(1)).cast("int")
    blocks = (base.withColumn("nb", n_blocks)
              .select("rid", "doc_id", "n_bytes", "nb", "sha", "bytes",
                      F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("i"))
              .select("rid", "i", "nb",
                      F.when(F.col("i") == 0, F.col("doc_id")).alias("doc_id"),
                      F.when(F.col("i") == 0, F.col("n_bytes")).alias("n_bytes"),
                      F.when(F.col("i") == 0, F.col("sha")).alias("text_sha256"),
                      F.substring("bytes", F.col("i") * block + 1, F.lit(block)).alias("blk")))
    names, digest = _block_names(blocks)
    looked_up = blocks.withColumn("h", digest(F.col("blk"))).drop("blk")
    first = staged(looked_up.join(names, "h").drop("h"), "blocks")

    def ended(frame: DataFrame, level: int) -> DataFrame:
        return frame.where("nb = 1").select("rid", F.lit(level).alias("level"), "name")

    done, level = ended(first, 0), 0
    current = first.select("rid", "i", "nb", "name")
    left = first.agg(F.max("nb")).first()[0] or 1
    while left > 1:
        level += 1
        even = F.col("i") % 2 == 0
        pairs = (current.where("nb > 1")
                 .groupBy("rid", F.shiftright("i", 1).alias("i"))
                 .agg(F.max("nb").alias("nb"), F.max(F.when(even, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b")))
        named = staged(_named(pairs.select("a", "b").distinct(), ["a", "b"]), "pair-names")
        current = staged(pairs.join(named, ["a", "b"]).select(
            "rid", "i", F.ceil(F.col("nb") / 2).cast("int").alias("nb"), "name"), "pairs")
        done = done.unionByName(ended(current, level))
        left = (left + 1) // 2
    own = first.where("i = 0").select("rid", "doc_id", "n_bytes", "text_sha256")
    return own.join(done, "rid")


def exact_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 block: int = BLOCK) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    named = staged(name_texts(df, doc_id, text, block), "names")
    groups = staged(named.groupBy("level", "name").agg(
        F.max(F.struct("doc_id", "rid")).alias("top"), F.count("*").alias("group_size")), "groups")
    return named.join(groups, ["level", "name"]).select(
        "doc_id", F.col("top.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("top.rid")).alias("kept"), "text_sha256")


def op8_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir, "doc_id", "text"))


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
