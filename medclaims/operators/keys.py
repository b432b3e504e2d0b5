"""Dense numbering at scale: surrogate keys (K1) and ranks."""

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medclaims.sources.tables import TableStore

# monotonically_increasing_id holds the partition above, the row below this bit
_ROW_BITS = 33

# wide rows that one task sorts
ROWS_PER_TASK = 100_000


def tasks_for(df: DataFrame) -> int:
    """How many tasks have ``ROWS_PER_TASK`` rows of ``df`` each; of a stored table its statistics are counted."""
    return max(1, math.ceil(df.count() / ROWS_PER_TASK))


def with_surrogate_key(
    df: DataFrame,
    name: str,
    order_by: Sequence[str | Column],
    store: TableStore,
    distinct: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """K1: ``name`` = 1..n in ``order_by`` order (a string sorts ascending, NULLs first).

    Equal to ROW_NUMBER over the whole table without sending the table through
    one task: rows are range-partitioned and sorted, written once with their
    place in their partition, and shifted by the sizes of the partitions before.
    Only one row per partition is ever brought together. The written copy fixes
    the (sampled) range bounds, so both passes see the same partitions.

    ``order_by`` must tell all rows apart; then the keys do not depend on the
    number of partitions, and hot leading values are still split. With ``distinct``
    it must name all columns, and repeated rows are dropped: they meet in the range
    partition that numbers them, so that takes no shuffle of its own. ``tasks`` is the number of
    range partitions; without it the session decides, by their bytes, which say little of wide rows.
    """
    order = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]
    ranged = df.repartitionByRange(*order) if tasks is None else df.repartitionByRange(tasks, *order)
    placed = (
        (ranged.distinct() if distinct else ranged)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = store.scratch(name, placed)
    partition = F.shiftright("_place", _ROW_BITS)
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = placed.groupBy(partition.alias("_partition")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    # one row per partition: bounded by the partition count, not by the data
    numbered = placed.withColumn("_partition", partition).join(F.broadcast(starts), "_partition")
    return numbered.withColumn(name, F.col("_start") + row + 1).select(name, *df.columns)


def with_rank(
    df: DataFrame, name: str, order_by: Sequence[Column], store: TableStore, partition_by: Sequence[str] = ()
) -> DataFrame:
    """ROW_NUMBER as column ``name``, numbered as in K1 at every size.

    Rows are numbered in (group, ``order_by``) order, and the number of a group's
    first row is taken off. NULL is a group like any other. ``order_by`` must be a total order.
    """
    groups = [F.col(c).asc_nulls_first() for c in partition_by]
    numbered = with_surrogate_key(df, "_number", [*groups, *order_by], store)
    first = F.lit(1)
    if partition_by:
        firsts = numbered.groupBy(*[F.col(c).alias(f"_{c}") for c in partition_by]).agg(F.min("_number").alias("_first"))
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in partition_by])
        numbered, first = numbered.join(firsts, same), F.col("_first")
    return numbered.withColumn(name, (F.col("_number") - first + 1).cast("int")).select(*df.columns, name)


def with_ranks(
    df: DataFrame, measures: dict[str, str], tie: str, store: TableStore, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Several ranks at once, each by its own measure from large to small
    (NULL first), ties by ``tie``, which must be unique within a group.

    The rows are stored once. Their measures, stacked as one narrow frame, are
    numbered in (rank, group, measure, tie) order in one go, and the numbers go back
    to the rows by row number.
    """
    stored = store.scratch("ranked", df.withColumn("_row", F.monotonically_increasing_id()))
    groups = [F.col(c).alias(f"_{c}") for c in partition_by]
    stacked = reduce(
        DataFrame.unionByName,
        [
            stored.select(F.lit(i).alias("_rank"), *groups, F.col(m).alias("_measure"), F.col(tie).alias("_tie"), "_row")
            for i, m in enumerate(measures.values())
        ],
    )
    order = ["_rank", *[f"_{c}" for c in partition_by], F.col("_measure").desc_nulls_first(), "_tie"]
    numbered = with_surrogate_key(stacked, "_number", order, store).drop("_measure", "_tie")
    same = ["_rank", *[f"_{c}" for c in partition_by]]
    firsts = numbered.groupBy(*[F.col(c).alias(f"{c}_") for c in same]).agg(F.min("_number").alias("_first"))
    joined = numbered.join(firsts, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in same]))
    rank = (F.col("_number") - F.col("_first") + 1).cast("int")
    ranks = joined.groupBy("_row").agg(
        *[F.max(F.when(F.col("_rank") == i, rank)).alias(name) for i, name in enumerate(measures)]
    )
    return stored.join(ranks, "_row").select(*df.columns, *measures)


def identity_of(columns: Sequence[str]) -> Column:
    """A digest that tells rows apart by ``columns``, NULLs included."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def with_stable_key(
    df: DataFrame, name: str, order_by: Sequence[str], identity: Sequence[str], known: DataFrame, store: TableStore
) -> DataFrame:
    """K1 on a reload: rows in ``known`` (identity, key) keep their keys, the others
    are numbered after all keys ever given, so no key ever changes its meaning.
    """
    old = known.select(F.col("identity").alias("_identity"), F.col(name))
    matched = df.withColumn("_identity", identity_of(identity)).join(old, "_identity", "left")
    matched = store.scratch("matched", matched.drop("_identity"))
    last = known.agg(F.max(name)).first()[0] or 0
    new = with_surrogate_key(matched.where(F.col(name).isNull()).drop(name), name, order_by, store)
    kept = matched.where(F.col(name).isNotNull()).select(name, *df.columns)
    return kept.unionByName(new.withColumn(name, F.col(name) + last))
