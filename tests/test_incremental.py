"""Marks, unseen keys and latest rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from starfeed.operators import after_mark, high_water_mark, latest_by_key, new_rows, repeated_keys
from starfeed.operators.incremental import key_set


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_mark(spark):
    days = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 2, 1),), (None,)], "d date")
    assert high_water_mark(days, "d") == date(2024, 2, 1)
    assert high_water_mark(days.where("false"), "d") is None
    assert high_water_mark(None, "d") is None
    with pytest.raises(ValueError):
        high_water_mark(days.where("d is null"), "d")


def test_after_mark_is_strict_and_optional(spark):
    days = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 2, 1),), (None,)], "d date")
    assert rows(after_mark(days, "d", date(2024, 1, 1))) == [(date(2024, 2, 1),)]
    assert after_mark(days, "d", None).count() == 3


@pytest.mark.parametrize("probe", [None, 100, 0])
def test_new_rows(spark, probe):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", None), ("c", None)], "v string, k int")
    stored = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    unseen = new_rows(df, stored, "k", probe=probe, probe_rows=0)
    assert unseen.columns == ["v", "k"]
    assert rows(unseen) == [("b", 2), ("b", 3)]
    raw = new_rows(df, stored, "k", null_safe=False, probe=probe, probe_rows=0)
    assert rows(raw) == [("b", 2), ("b", 3), ("c", None), ("c", None)]
    assert rows(new_rows(df, None, "k", probe=probe, probe_rows=0)) == rows(df)


@pytest.mark.parametrize("probe", [None, 100, 0])
def test_new_rows_by_two_keys(spark, probe):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, None)], "k int, t string")
    stored = spark.createDataFrame([(1, "x"), (2, None)], "k int, t string")
    assert rows(new_rows(df, stored, ["k", "t"], probe=probe, probe_rows=0)) == [(1, "y")]


def test_changed_attributes_are_not_new(spark):
    df = spark.createDataFrame([(1, "later")], "k int, v string")
    assert new_rows(df, df.withColumn("v", F.lit("first")), "k").isEmpty()


def test_latest_by_key(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, "x"), ("a", 2, 1, "y"), ("a", 2, 0, "z"), ("b", None, 1, "n"), (None, 1, 1, "k")],
        "k string, t int, tie int, v string",
    )
    got = latest_by_key(df, "k", ["t", "tie"])
    assert got.columns == df.columns
    assert rows(got) == sorted([("a", 2, 1, "y"), ("b", None, 1, "n"), (None, 1, 1, "k")], key=str)


def test_latest_rows_are_not_sorted_whole(spark, tmp_path):
    rows = [(i % 5, i // 7, float(i % 3), f"text {i}", None if i % 4 else "x") for i in range(200)]
    rows += [(9, None, None, "no order", None), (9, None, 1.0, "some", None), (8, 3, 1.0, "copy", "p"), (8, 3, 1.0, "copy", "p"), (8, 3, 1.0, "other", "p")]
    spark.createDataFrame(rows, "k long, t long, tie double, props string, extra string").write.parquet(str(tmp_path / "t"))
    got = latest_by_key(spark.read.parquet(str(tmp_path / "t")), "k", ["t", "tie"])
    least = (-1, -1.0)
    want = {}
    for r in rows:
        order = (least[0] if r[1] is None else r[1], least[1] if r[2] is None else r[2])
        want.setdefault(r[0], {}).setdefault(order, set()).add(r)
    found = {r["k"]: tuple(r) for r in got.collect()}
    assert found.keys() == want.keys() and all(found[k] in by[max(by)] for k, by in want.items())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "BroadcastHashJoin" in plan


def test_repeated_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "a"), (None, "b")], "k int, v string")
    assert repeated_keys(df, "k").first()[0] == 2
    assert repeated_keys(df, ["k", "v"]).first()[0] == 0


@pytest.mark.parametrize("limit", [100, 0])
def test_cut_to_a_key_set(spark, limit):
    df = spark.createDataFrame([(1, "a"), (3, "b"), (3, "b"), (5, "c"), (9, "d"), (None, "n")], "k int, v string")
    for wanted, left in (([3, 5], "bbc"), ([3, None], "bbn"), ([None], "n"), ([], "")):
        keys = spark.createDataFrame([(k,) for k in wanted], "k int")
        found = key_set(keys, limit)
        assert found.few == (len(wanted) <= limit)
        assert sorted(r["v"] for r in found.cut(df).collect()) == list(left)


def test_text_keys_are_measured(spark):
    keys = spark.createDataFrame([("x" * 500,)], "k string")
    assert not key_set(keys, 10).few
    assert key_set(keys, 13).few


def test_the_span_of_keys_reaches_the_scan(spark, tmp_path):
    spark.range(100).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "t"))
    keys = spark.createDataFrame([(7,), (9,)], "k long")
    cut = key_set(keys, 10).cut(spark.read.parquet(str(tmp_path / "t")))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,7), LessThanOrEqual(k,9)" in plan
    assert "Broadcast" in plan
