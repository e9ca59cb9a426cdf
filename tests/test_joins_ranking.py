from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ranking
from tidemark.operators.joins import fits, hot_keys, skew_join
from tidemark.session import scratch_path
from tidemark.spec import FeedSpec

SPEC = FeedSpec("k", "t", ("v",), ("id",))


def skewed(spark, n=3000, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        pick = rng.random()
        key = "hot" if pick < 0.4 else None if pick < 0.5 else f"k{rng.randrange(200)}"
        rows.append((i, key, rng.choice([None, *range(40)])))
    return spark.createDataFrame(rows, "id int, k string, t int"), rows


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("small", [False, True])
def test_skew_join_equals_the_plain_join(spark, how, small):
    left, _ = skewed(spark)
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), (None, 9)] + [(f"k{i}", i) for i in range(0, 200, 2)], "k string, r int"
    )
    hot = hot_keys(left, ["k"], hot_rows=100)
    assert {r.k: r._splits for r in hot.collect()}["hot"] >= 10
    got = skew_join(left, right, ["k"], how, ["id"], None, 100, small)
    wanted = left.join(right, "k", how)
    assert sorted(map(str, got.select("id", "k", "t", "r").collect())) == sorted(
        map(str, wanted.select("id", "k", "t", "r").collect())
    )


def test_hot_key_is_spread_over_salts(spark):
    left, _ = skewed(spark)
    right = spark.createDataFrame([("hot", 1)], "k string, r int")
    joined = skew_join(left, right, ["k"], "inner", ["id"], hot_rows=100, small=False)
    text = joined._jdf.queryExecution().toString()
    assert "_salt" in text and "Cartesian" not in text
    assert "_salt" not in skew_join(left, right, ["k"], "inner", ["id"])._jdf.queryExecution().toString()
    assert joined.count() == left.filter("k = 'hot'").count()


def test_hot_keys_take_no_shuffle_of_the_rows(spark):
    path, other = scratch_path(spark, "left"), scratch_path(spark, "right")
    skewed(spark)[0].write.parquet(path)
    spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, r int").write.parquet(other)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.read.parquet(path)
        joined = skew_join(left, spark.read.parquet(other), ["k"], "left", ["id"], hot_rows=100, small=False)
        text = joined._jdf.queryExecution().executedPlan().toString()
        # Only the join itself sorts and shuffles: the hot keys come to both sides as they are.
        assert (text.count("SortMergeJoin"), text.count("BroadcastHashJoin")) == (1, 2)
        assert joined.count() == left.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_size_check(spark):
    assert fits(spark.range(10), 10) and not fits(spark.range(11), 10) and not fits(spark.range(0), 0)


def test_other_join_types_are_refused(spark):
    left, _ = skewed(spark, 10)
    with pytest.raises(ValueError):
        skew_join(left, left, ["k"], "full_outer", ["id"])


def test_latest_puts_missing_times_last(spark):
    rows = [
        ("a", 1, "old", 1), ("a", 5, "new", 2), ("a", None, "untimed", 3),
        ("b", None, "first", 4), ("b", None, "second", 5),
        ("c", 7, "low", 6), ("c", 7, "high", 7),
    ]
    got = ranking.latest_per_key(spark.createDataFrame(rows, "k string, t int, v string, id int"), SPEC)
    assert sorted((r.k, r.t, r.v) for r in got.collect()) == sorted(
        [("a", 5, "new"), ("b", None, "second"), ("c", 7, "high")], key=str
    )


def test_latest_matches_a_window_on_skewed_input(spark):
    from pyspark.sql import Window

    frame, _ = skewed(spark)
    frame = frame.withColumn("v", F.col("id") * 2)
    order = Window.partitionBy("k").orderBy(F.desc_nulls_last("t"), F.desc("id"))
    wanted = frame.withColumn("n", F.row_number().over(order)).filter("n = 1").select("k", "v", "t")
    got = ranking.latest_per_key(frame, SPEC)
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))


def test_ordinal_is_the_global_row_number(spark):
    frame, rows = skewed(spark)
    # Nearly all rows share one event time, so ranges must cut inside the tie.
    frame = frame.withColumn("t", F.when(F.col("id") % 10 == 0, F.col("t")).otherwise(7))
    got = ranking.with_ordinal(frame.repartition(9), [F.desc_nulls_last("t"), F.desc("id")]).collect()
    assert sorted(r.ordinal for r in got) == list(range(1, len(rows) + 1))
    ordered = sorted(got, key=lambda r: r.ordinal)
    expected = sorted(got, key=lambda r: (r.t is None, -(r.t or 0), -r.id))
    assert [r.id for r in ordered] == [r.id for r in expected]


def test_ordinal_sends_only_partition_sizes_through_one_task(spark):
    frame, _ = skewed(spark)
    plan = ranking.with_ordinal(frame, [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(single) == 1
    assert "broadcast" in plan.lower()


def test_ordinal_of_nothing(spark):
    empty = spark.createDataFrame([], "id int")
    assert ranking.with_ordinal(empty, [F.col("id")]).collect() == []


def test_surrogates_continue_and_repeat(spark):
    keys = spark.createDataFrame([(f"k{i:03}",) for i in range(100)], "k string")
    first = ranking.surrogate_keys(keys.repartition(5), "k", "n", 41).collect()
    second = ranking.surrogate_keys(keys.repartition(3), "k", "n", 41).collect()
    assert sorted(first) == sorted(second)
    assert [r.n for r in sorted(first)] == list(range(41, 141))
