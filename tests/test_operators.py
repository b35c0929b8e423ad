import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rainledger.operators import (
    QualityError,
    Tile,
    assert_no_nulls,
    assert_not_all_null,
    assert_not_empty,
    assert_unique,
    broadcast_if_small,
    global_ntile,
    grain_violations,
    keep_first,
    layer_counts,
    null_profile,
    rolling_sums,
    surrogate_key,
)


def test_keep_first_settles_ties_by_the_other_columns(spark):
    rows = [(1, "b", 2), (1, "a", 9), (1, "a", 3), (2, None, 1), (2, "z", 5)]
    df = spark.createDataFrame(rows, "k int, o string, v int")
    kept = keep_first(df, ["k"], [F.col("o").asc_nulls_last()]).orderBy("k").collect()
    assert [tuple(r) for r in kept] == [(1, "a", 3), (2, "z", 5)]
    assert keep_first(df.select("k"), ["k"]).count() == 2


def test_keep_first_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = keep_first(df, ["k"], [F.col("id").asc()])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[exchange:], plan


def test_rolling_sums_count_rows_not_days(spark):
    days = [20260101, 20260102, 20260103, 20260105, 20260106, 20260107, 20260108, 20260109]
    df = spark.createDataFrame([("p", d, float(i + 1)) for i, d in enumerate(days)], "place string, day int, v double")
    out = rolling_sums(df, ["place"], ["day"], {"s7": ("v", 7), "s2": ("v", 2)}).orderBy("day").collect()
    assert out[7]["s7"] == sum(range(2, 9))
    assert out[0]["s7"] == 1.0 and out[1]["s2"] == 3.0
    nulls = df.withColumn("v", F.lit(None).cast("double"))
    assert rolling_sums(nulls, ["place"], ["day"], {"s": ("v", 3)}).where("s IS NOT NULL").isEmpty()


def plain_ntile(df, buckets, tiles, tiebreak):
    """The single-task window the scalable form must equal."""
    out = df
    for t in tiles:
        direction = f"{'desc' if t.descending else 'asc'}_nulls_{'first' if t.nulls_first else 'last'}"
        order = [getattr(F.col(t.column), direction)(), *[F.col(c).asc_nulls_last() for c in tiebreak]]
        out = out.withColumn(t.name, F.ntile(buckets).over(Window.orderBy(*order)).cast("bigint"))
    return out


TILES = [
    Tile("a", "x", descending=True),
    Tile("b", "x"),
    Tile("c", "y", descending=True, nulls_first=True),
    Tile("d", "y", nulls_first=True),
    Tile("e", "y"),
]


@pytest.mark.parametrize("rows, buckets", [(0, 4), (1, 4), (3, 4), (4, 4), (39, 4), (1429, 4), (500, 7)])
def test_global_ntile_equals_the_window(spark, rows, buckets):
    random.seed(rows)
    data = [
        (i, random.choice([1, 1, 1, 2, 5]), random.choice([None, 0.5, 1.25, random.random()]), random.choice([None, "t"]))
        for i in range(rows)
    ]
    df = spark.createDataFrame(data, "id int, x int, y double, z string").repartition(3)
    tiebreak = ["z", "id"]
    got = sorted(map(repr, global_ntile(df, buckets, TILES, tiebreak).collect()))
    assert got == sorted(map(repr, plain_ntile(df, buckets, TILES, tiebreak).collect()))


def test_global_ntile_over_many_sort_partitions(spark):
    """With coalescing off, the bucket ends lie in different partitions of the sort."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(10_000).select("id", (F.col("id") * 7919 % 100).alias("x"), F.lit(1.0).alias("y"))
        got = global_ntile(df, 4, TILES[:2], ["id"])
        want = plain_ntile(df, 4, TILES[:2], ["id"])
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        sizes = got.groupBy("a").count().agg(F.max("count") - F.min("count")).first()[0]
        assert sizes <= 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_surrogate_key_equals_row_number(spark, coalesce):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        df = spark.range(999).select((F.col("id") * 37 % 101).alias("name"), F.col("id").alias("other"))
        got = surrogate_key(df, ["name"], "key")
        want = df.withColumn("key", F.row_number().over(Window.orderBy("name", "other")).cast("bigint"))
        assert got.columns == ["name", "other", "key"]
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        assert surrogate_key(df.where("false"), ["name"], "key").isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_grain_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    assert {tuple(r) for r in grain_violations(df, ["k"]).collect()} == {(1, 2), (None, 2)}
    with pytest.raises(QualityError, match="2 values"):
        assert_unique(df, ["k"], "t")
    assert_unique(df, ["k", "v"])


def test_null_checks(spark):
    df = spark.createDataFrame([(1, None, None), (2, 5, None)], "a int, b int, c int")
    assert {tuple(r) for r in null_profile(df, ["a", "b", "c"]).collect()} == {("a", 2, 0), ("b", 2, 1), ("c", 2, 2)}
    assert assert_not_all_null(df, "b") == 1
    with pytest.raises(QualityError, match="all 2 rows"):
        assert_not_all_null(df, "c")
    with pytest.raises(QualityError, match="'b', 'c'"):
        assert_no_nulls(df, ["a", "b", "c"])
    with pytest.raises(QualityError):
        assert_not_empty(df.where("a > 5"))
    assert_not_empty(df)


def test_layer_counts(spark):
    counts = layer_counts({"a": spark.range(3).toDF("id"), "b": spark.range(0).toDF("id")})
    assert {tuple(r) for r in counts.collect()} == {("a", 3), ("b", 0)}
    with pytest.raises(QualityError):
        layer_counts({})


def test_only_a_small_side_is_broadcast(spark):
    facts, side = spark.range(100).toDF("id"), spark.range(10).select("id", F.col("id").alias("name"))

    def plan(max_rows):
        joined = facts.join(broadcast_if_small(side, max_rows), "id")
        return joined._jdf.queryExecution().optimizedPlan().toString()

    assert "broadcast" in plan(10) and "broadcast" not in plan(9)
