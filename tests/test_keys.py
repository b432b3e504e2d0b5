import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from medclaims.operators.keys import identity_of, with_rank, with_ranks, with_stable_key, with_surrogate_key


def _rows(n, seed):
    rng = random.Random(seed)
    # a third of the rows share their first value, some are NULL
    first = [rng.choice(["hot", None, *map(str, range(50))]) if i % 3 else "hot" for i in range(n)]
    return [(value, i if i % 11 else None, i) for i, value in enumerate(first)]


def _expected(rows):
    def nulls_first(x):
        return (x is not None, x if x is not None else 0)

    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", *nulls_first(r[1]), r[2]))
    return {row[2]: position for position, row in enumerate(ordered, 1)}


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_surrogate_key_is_the_row_number_for_any_partitioning(spark, store, partitions):
    rows = _rows(2000, 1)
    df = spark.createDataFrame(rows, "a string, b int, c int").repartition(partitions)
    keyed = with_surrogate_key(df, "key", ["a", "b", "c"], store)
    assert keyed.columns == ["key", "a", "b", "c"]
    assert {r.c: r.key for r in keyed.collect()} == _expected(rows)


def test_surrogate_key_without_adaptive_merging(spark, store):
    rows = _rows(500, 2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "a string, b int, c int")
        keyed = {r.c: r.key for r in with_surrogate_key(df, "key", ["a", "b", "c"], store).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert keyed == _expected(rows)


def test_surrogate_key_of_nothing(spark, store):
    df = spark.createDataFrame([], "a string")
    assert with_surrogate_key(df, "key", ["a"], store).count() == 0


def test_ranks_with_ties_and_null_groups(spark, store):
    rng = random.Random(3)
    rows = [(f"p{i:04}", rng.choice(["x", "y", None]), rng.choice([None, 1, 2, 3])) for i in range(600)]
    df = spark.createDataFrame(rows, "id string, kind string, total int")
    order = [F.col("total").desc_nulls_first(), F.col("id").asc()]
    for groups in ([], ["kind"]):
        window = Window.partitionBy(*groups).orderBy(*order)
        expected = df.withColumn("rank", F.row_number().over(window))
        ranked = with_rank(df, "rank", order, store, groups)
        assert ranked.schema.simpleString() == expected.schema.simpleString()
        assert sorted(map(repr, map(tuple, ranked.collect()))) == sorted(map(repr, map(tuple, expected.collect())))


def test_several_ranks_at_once(spark, store):
    rng = random.Random(4)
    rows = [(f"p{i:04}", rng.choice(["x", "x", "y", None]), rng.choice([None, 1, 2, 3]), i % 7) for i in range(600)]
    df = spark.createDataFrame(rows, "id string, kind string, total int, n bigint").selectExpr("id", "kind", "cast(total as decimal(20,2)) as total", "n")
    for groups in ([], ["kind"]):
        expected = df
        for name, measure in (("a", "total"), ("b", "n")):
            window = Window.partitionBy(*groups).orderBy(F.col(measure).desc_nulls_first(), F.col("id").asc())
            expected = expected.withColumn(name, F.row_number().over(window))
        ranked = with_ranks(df.repartition(5), {"a": "total", "b": "n"}, "id", store, groups)
        assert ranked.schema.simpleString() == expected.schema.simpleString()
        assert sorted(map(repr, map(tuple, ranked.collect()))) == sorted(map(repr, map(tuple, expected.collect())))


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_surrogate_key_of_distinct_rows(spark, store, partitions):
    rows = [(value, number, i % 40) for value, number, i in _rows(900, 6)] * 2
    df = spark.createDataFrame(rows, "a string, b int, c int").repartition(partitions)
    keyed = with_surrogate_key(df, "key", df.columns, store, distinct=True).collect()
    again = with_surrogate_key(df.distinct(), "key", df.columns, store).collect()
    assert sorted(map(repr, keyed)) == sorted(map(repr, again)) and len(keyed) == len(set(rows))


def test_known_rows_keep_their_keys(spark, store):
    old = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("gone", 9)], "id string, key long")
    known = old.select(identity_of(["id"]).alias("identity"), "key")
    df = spark.createDataFrame([(i,) for i in ("0", "a", "b", None, "z")], "id string")
    keyed = {r.id: r.key for r in with_stable_key(df, "key", ["id"], ["id"], known, store).collect()}
    assert keyed == {"a": 1, "b": 2, None: 3, "0": 10, "z": 11}
    none = with_stable_key(df, "key", ["id"], ["id"], known.limit(0), store)
    assert sorted(r.key for r in none.collect()) == [1, 2, 3, 4, 5]


def test_keyed_frames_outlive_another_table(spark, store):
    df = spark.createDataFrame(_rows(200, 5), "a string, b int, c int")
    first, second = (with_surrogate_key(df, "key", ["a", "b", "c"], store) for _ in range(2))
    store.replace("FIRST", first)
    assert second.count() == 200
    with store.scope():
        inner = with_surrogate_key(df, "key", ["a", "b", "c"], store)
        assert inner.count() == 200
    assert second.count() == 200
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        inner.count()
