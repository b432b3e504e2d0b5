"""Operator 7: weighted rendezvous hashing of record keys.

Every record scores each shard by ``-weight / ln(u)``, ``u`` being a uniform
hash of (key, shard), and goes to the highest score. A new shard only adds one
score per record, so rows move into it and nowhere else, in proportion to its
weight. Only DataFrame functions are used.

Places in a shard are numbered by range partitions of (shard, key) and their
sizes, so no shard passes through one task. A NULL key is one more key; repeated
rows get neighbouring places; a NULL text has no bytes, a very long one is read once. An empty table gives an
empty result, and other columns are never looked at.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medclaims.llm.common import numbered, scratch

LAW = "key"


def uniform(key: Column, shard: int) -> Column:
    """A number in (0, 1) from 52 bits of a hash of the key and the shard."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f":{shard}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key; equal scores go to the lower number."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    scores = [
        F.struct((-weight / F.ln(uniform(key, shard))).alias("score"), F.lit(-shard).alias("back"))
        for shard, weight in enumerate(weights)
    ]
    return -F.array_max(F.array(*scores))["back"]


def shard_rows(docs: DataFrame, weights: Sequence[float], new_weight: float = 1.0) -> DataFrame:
    """Shard and place of every document, and its shard once one more is added.

    The new shard wins where its score beats those of all old shards.
    """
    placed = docs.select(
        "doc_id",
        (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        rendezvous(F.col("doc_id"), weights).alias("shard"),
        rendezvous(F.col("doc_id"), [*weights, new_weight]).alias("grown_shard"),
    )
    rows = numbered(scratch(placed, "placed"), "number", ["shard", "doc_id", "text_crc32", "size"])
    rows = scratch(rows, "sharded")
    firsts = rows.groupBy("shard").agg(F.min("number").alias("first"))
    # one row per shard
    return rows.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("number") - F.col("first")).alias("slot"), "grown_shard",
    )
