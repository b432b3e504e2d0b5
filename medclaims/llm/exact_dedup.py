"""Operator 10: exact dedup with a split for heavy hitters.

Texts are equal when they are identical after lower-casing A-Z. A Misra-Gries
pass over the digests finds every digest of at least ``2 * rows / counters``
rows. Those candidates, ``counters`` at most, are counted again exactly; the
verified winners are broadcast and their groups are settled without a shuffle.
All other digests are aggregated and joined as usual, where no group is larger
than that bound.

NULL text counts as empty, and very long texts are hashed whole. The row with the largest ``doc_id`` stays (NULL is
the least); of repeated rows with one ``doc_id`` exactly one stays. Other columns
are never looked at. An empty table gives an empty result.
"""

import heapq
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medclaims.llm.common import scratch, with_rows

# Misra-Gries counters per partition; also bounds the broadcast winners
COUNTERS = 4096


def digests(docs: DataFrame) -> DataFrame:
    """(row, doc_id, digest) of rows with ``row``, ``doc_id`` and ``text``."""
    lowered = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return docs.select("row", "doc_id", F.sha2(lowered, 256).alias("digest"))


def _misra_gries(counters: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            found = batch.column("digest").value_counts()
            for digest, n in zip(found.field("values").to_pylist(), found.field("counts").to_pylist()):
                counts[digest] = counts.get(digest, 0) + n
            if len(counts) > counters:
                cut = heapq.nlargest(counters + 1, counts.values())[-1]
                counts = {digest: n - cut for digest, n in counts.items() if n > cut}
        yield pa.RecordBatch.from_pydict(
            {"digest": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())}
        )

    return summarise


def frequent_digests(table: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests, among them every one of 2 * rows / counters rows.

    A partition's counter misses at most rows / counters of a digest; the merged
    counters sum to at most all rows, so at most ``counters`` of them reach the limit.
    """
    summaries = table.select("digest").mapInArrow(_misra_gries(counters), "digest string, n long")
    limit = max(2, -(-table.count() // counters))
    return summaries.groupBy("digest").agg(F.sum("n").alias("n")).where(F.col("n") >= limit).select("digest")


def copy_groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(row, doc_id, digest, keep_id, keep_row, group_size) for rows with a ``row`` id."""
    table = scratch(digests(docs), "digests")
    group = [F.max(F.struct("doc_id", "row")).alias("winner"), F.count("*").alias("group_size")]
    candidates = frequent_digests(table, counters)
    # bounded by `counters` rows, as are the winners counted from them
    winners = scratch(table.join(F.broadcast(candidates), "digest").groupBy("digest").agg(*group), "winners")
    seen = table.join(F.broadcast(winners), "digest", "left")
    heavy = seen.where(F.col("group_size").isNotNull())
    rest = seen.where(F.col("group_size").isNull()).select(*table.columns)
    light = rest.join(rest.groupBy("digest").agg(*group), "digest")
    return heavy.unionByName(light).select(
        "row", "doc_id", "digest", F.col("winner.doc_id").alias("keep_id"),
        F.col("winner.row").alias("keep_row"), "group_size",
    )


def exact_groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document, dropped ones too."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return copy_groups(rows, counters).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The documents that stay, with all their columns."""
    base = with_rows(docs, "with_rows")
    copies = copy_groups(base.select("row", "doc.doc_id", "doc.text"), counters)
    kept = copies.where(F.col("row") == F.col("keep_row")).select("row")
    return base.join(kept, "row", "left_semi").select("doc.*")
