"""Split joins give what plain joins give, and do split."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from starfeed.operators import hot_keys, new_rows, skew_join

keys = st.one_of(st.none(), st.integers(0, 4))
sides = st.lists(st.tuples(keys, st.integers(0, 9)), max_size=25)


def plain(left, right, how):
    return left.join(right.withColumnRenamed("k", "k2"), F.col("k") == F.col("k2"), how)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=sides, right=sides, pieces=st.integers(2, 7))
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(spark, how, left, right, pieces):
    a = spark.createDataFrame(left, "k int, x int").coalesce(1)
    b = spark.createDataFrame(right, "k int, y int").coalesce(1)
    on_left = {k: pieces for k in {k for k, _ in left} if k is None or k < 3}
    on_right = {k: pieces + 1 for k in {k for k, _ in right} if k is not None and k > 1}
    got = skew_join(a, b, "k", how, on_left, on_right)
    want = plain(a, b, how).select(got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_null_safe(spark):
    a = spark.createDataFrame([(None, 1), (1, 2)], "k int, x int")
    b = spark.createDataFrame([(None,), (2,)], "k int")
    assert [r["x"] for r in skew_join(a, b, "k", "left_anti", {None: 3}, null_safe=True).collect()] == [2]
    assert len(skew_join(a, b, "k", "left_anti", {None: 3}).collect()) == 2


def test_other_joins_are_refused(spark):
    with pytest.raises(ValueError):
        skew_join(spark.range(1), spark.range(1), "id", "full")


def third_of_all(spark, n=30_000):
    """Key 7 and the NULL key hold a third of the rows each, the rest are unique."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") + 100).alias("k"), F.col("id").alias("x")
    )


def test_hot_keys_are_found_with_fitting_pieces(spark):
    hot = hot_keys(third_of_all(spark), ["k"], share=0.02, min_rows=0)["k"]
    assert set(hot) == {7, None}
    assert 16 <= hot[7] <= 17


def test_keys_of_few_rows_are_not_hot(spark):
    assert hot_keys(third_of_all(spark), ["k"]) == {"k": {}}
    assert set(hot_keys(third_of_all(spark), ["k"], min_rows=9_000)["k"]) == {7, None}


def test_the_share_follows_the_number_of_tasks(spark):
    """With very many tasks a key far below 0.05 % of the rows is still split."""
    df = spark.range(200_000).select(F.when(F.col("id") % 4000 == 0, -1).otherwise(F.col("id")).alias("k"))
    spark.conf.set("spark.sql.shuffle.partitions", "40000")
    try:
        assert set(hot_keys(df, ["k"], min_rows=0)["k"]) == {-1}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_hot_rows_spread_over_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = third_of_all(spark)
        dims = spark.createDataFrame([(7, "a")], "k long, name string")
        hot = hot_keys(df, ["k"], share=0.02, min_rows=0)["k"]

        def largest_task(joined):
            sizes = joined.groupBy(F.spark_partition_id()).count()
            return sizes.agg(F.max("count")).first()[0]

        assert largest_task(skew_join(df, dims, "k")) == 10_000
        assert largest_task(skew_join(df, dims, "k", left_hot=hot)) < 5_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_hot_anti_join(spark):
    df = third_of_all(spark)
    hot = hot_keys(df, ["k"], share=0.02, min_rows=0)["k"]
    stored = spark.createDataFrame([(7,), (None,), (101,)], "k long")
    for null_safe, left in ((True, 9_999), (False, 19_999)):
        assert new_rows(df, stored, "k", null_safe, hot).count() == left
        assert new_rows(df, stored, "k", null_safe, hot, probe=1_000_000, probe_rows=0).count() == left
        assert new_rows(df, stored, "k", null_safe, hot, probe=5, probe_rows=0).count() == left
