"""Operator 5: mix sources to target weights.

Every document gets a hash-random key. Within a source, keys are range-sorted:
buckets of the key range hold a few thousand documents each, bucket sums give
each bucket its place on the source's line of tokens, and a running sum inside
the bucket gives each document its own. A source takes whole epochs and then the
documents up to the exact cut, so a hot source is spread over its buckets.

A very long text is one document, whole. NULL source is a source of its own, last in order; NULL text has size 0 and is
never taken; repeated rows are documents of their own and lie side by side on
the line. An empty table, or one without words, takes nothing. Other columns are
never looked at.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medclaims.llm.common import WORD_PATTERN, numbered, scratch, with_rows

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
# documents of a source that share one bucket of its key range, about
BUCKET_DOCS = 4096
_KEY_BITS = 52


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def measured(rows: DataFrame) -> DataFrame:
    """(row, doc_id, source, size, key) of rows with a ``row`` id."""
    key = F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")))))
    return rows.select("row", "doc_id", "source", token_count(F.col("text")).alias("size"), key.alias("key"))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most_epochs: float = MOST_EPOCHS
) -> DataFrame:
    """(source, docs, source_size, target) per source.

    Weights repeat over the sources in code point order. A target is
    ``level * weight``, or the cap where that is lower; the level is raised until
    the targets sum to the share. Each step is one aggregate over the sources.
    """
    sums = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    ranked = numbered(scratch(sums, "sources"), "rank", [F.col("source").asc_nulls_last()])
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    ranked = scratch(ranked.withColumn("cap", F.col("source_size") * float(most_epochs)), "weights")
    total, weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    level = share * total / weight if weight else 0.0
    while True:
        below = F.col("cap") <= F.col("weight") * level
        capped, weight = ranked.agg(
            F.sum(F.when(below, F.col("cap"))), F.sum(F.when(~below, F.col("weight")))
        ).first()
        raised = (share * total - (capped or 0.0)) / weight if weight else level
        if raised <= level:
            break
        level = raised
    target = F.least(F.col("cap"), F.col("weight") * level)
    return ranked.select("source", "docs", "source_size", target.alias("target"))


def taken_tokens(rows: DataFrame, bucket_docs: int = BUCKET_DOCS, **mix) -> DataFrame:
    """(row, doc_id, source_size, target, size, before, epochs, rest, taken).

    ``epochs`` whole passes are taken, then the first ``rest`` tokens of the
    source's line, on which the document starts at ``before``.
    """
    sizes = scratch(measured(rows), "sizes")
    targets = scratch(source_targets(sizes, **mix), "targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("epochs", epochs.cast("long")).withColumn(
        "rest", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    )
    place = F.conv(F.substring("key", 1, _KEY_BITS // 4), 16, 10).cast("double") / F.lit(float(1 << _KEY_BITS))
    buckets = F.ceil(F.col("docs") / bucket_docs)
    joined = sizes.withColumnRenamed("source", "own").join(targets, F.col("own").eqNullSafe(F.col("source")))
    joined = scratch(joined.withColumn("bucket", F.floor(place * buckets).cast("long")).drop("own", "docs"), "line")
    # a row per bucket: one per few thousand documents of the source
    sums = joined.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("of_source"), F.col("bucket").alias("of_bucket"),
        F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("bucket_start"),
    )
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    line = joined.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        starts, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("bucket") == F.col("of_bucket"))
    ).withColumn("before", F.col("bucket_start") + F.col("inside"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    return line.select(
        "row", "doc_id", "source_size", "target", "size", "before", "epochs", "rest",
        (F.col("epochs") * F.col("size") + part).alias("taken"),
    )


def mix_tokens(docs: DataFrame, **mix) -> DataFrame:
    """What the mix takes of every document, cut at the exact token."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", "text")
    return taken_tokens(rows, **mix).select("doc_id", "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame, **mix) -> DataFrame:
    """Whole documents, once per epoch that takes some of them, with all columns."""
    base = with_rows(docs, "with_rows")
    taken = taken_tokens(base.select("row", "doc.doc_id", "doc.source", "doc.text"), **mix)
    last = ((F.col("size") > 0) & (F.col("before") < F.col("rest"))).cast("long")
    copies = taken.select("row", (F.col("epochs") * (F.col("size") > 0).cast("long") + last).alias("copies"))
    copies = copies.where(F.col("copies") > 0)
    return base.join(copies, "row").select(
        "doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("epoch")
    ).select("doc.*")
