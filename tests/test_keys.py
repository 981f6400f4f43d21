"""Key stores: unseen keys without moving the stored ones."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from fixtures import INPUTS, inputs
from starfeed.plans import daily, run_daily
from starfeed.sinks import ParquetWarehouse, keys as key_stores
from starfeed.sinks.keys import KEY, KeyStore, key_of
from starfeed.workspace import written

DATED = [r for r in INPUTS["pedidos"][1] if r[3]]


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], f"{KEY} string")


def seen(store, spark, attempts, *values):
    return sorted(r[0] for r in store.seen("t", keys(spark, *values), attempts).collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keys_are_told_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("null", None), ("", ""), ("1=x", "y"), ("1", "x1=y"), ("1", None)], "a string, b string")
    both = [r[0] for r in df.select(key_of(df, ["a", "b"])).collect()]
    assert len(set(both)) == len(both)
    assert [r[0] for r in df.select(key_of(df, ["a"])).limit(2).collect()] == ["null", "=null"]
    longs, doubles = spark.createDataFrame([(7,)], "k long"), spark.createDataFrame([(7.0,)], "k double")
    assert longs.select(key_of(longs, ["k"])).first() == doubles.select(key_of(doubles, ["k"])).first()


def test_attempts_that_are_not_named_are_not_seen(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path / "keys"))
    assert store.seen("t", keys(spark, "a"), []) is None
    store.add("t", keys(spark, "a", "b"), "one", 2)
    store.add("t", keys(spark, "c"), "two", 1)
    store.add("other", keys(spark, "d"), "one", 1)
    assert seen(store, spark, ["one"], "a", "c", "d") == ["a"]
    assert seen(store, spark, ["one", "two"], "a", "c", "d") == ["a", "c"]
    assert seen(KeyStore(spark, str(tmp_path / "keys")), spark, ["two"], "a", "c") == ["c"]


def test_the_history_is_not_shuffled(spark, tmp_path):
    """Only the extract's keys are: the stored side of the join comes straight from its buckets."""
    store = KeyStore(spark, str(tmp_path / "keys"), bucket_keys=100)
    store.add("t", spark.range(1000).select(F.col("id").cast("string").alias(KEY)), "one", 1000)
    asked = spark.range(900, 1100).select(F.col("id").cast("string").alias(KEY)).distinct()
    found = store.seen("t", asked, ["one"])
    assert found.count() == 100
    text = plan(found)
    assert "Bucketed: true" in text and "SelectedBucketsCount: 11 out of 11" in text
    assert "ShuffledHashJoin" in text and "LeftSemi, BuildRight" in text and "SortMergeJoin" not in text
    assert "Exchange" not in text.split("LeftSemi")[1].split("FileScan")[0]


def test_unseen_keys_take_one_pass(spark, tmp_path):
    """Keys and stored keys meet once: the extract's keys are held, the stored ones stream past where they are."""
    store = KeyStore(spark, str(tmp_path / "keys"), bucket_keys=100)
    asked = spark.range(900, 1100).select(F.col("id").cast("string").alias(KEY)).distinct()
    assert store.unseen("t", asked, ["one"]).count() == 200
    store.add("t", spark.range(1000).select(F.col("id").cast("string").alias(KEY)), "one", 1000)
    store.add("t", asked, "cut off", 200)
    store.add("t", spark.range(990, 1005).select(F.col("id").cast("string").alias(KEY)), "two", 15)
    found = store.unseen("t", asked, ["one", "two"])
    assert sorted(int(r[0]) for r in found.collect()) == list(range(1005, 1100))
    text = plan(found).split("Initial Plan")[0]
    assert text.count("Join") == 1 and "ShuffledHashJoin" in text and "LeftOuter, BuildLeft" in text
    stored = text.split("FileScan")[0].rsplit("Exchange", 1)[1]
    assert "Bucketed: true" in text and "_stored" in stored


def test_few_keys_open_the_buckets_they_hit(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path / "keys"), bucket_keys=100)
    store.add("t", spark.range(1000).select(F.col("id").cast("string").alias(KEY)), "one", 1000)
    found = store.seen("t", keys(spark, "7", "7", "1007"), ["one"], 3)
    assert [r[0] for r in found.collect()] == ["7"]
    opened = int(plan(found).split("SelectedBucketsCount: ")[1].split(" ")[0])
    assert opened <= 2
    assert store.seen("t", keys(spark), ["one"], 0).isEmpty()


def test_buckets_follow_the_number_of_keys(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path / "keys"), bucket_keys=10, loads=3)
    store.add("t", spark.range(5).select(F.col("id").cast("string").alias(KEY)), "one", 5)
    assert not store.tidy("t", ["one"], 5)
    store.add("t", spark.range(5, 100).select(F.col("id").cast("string").alias(KEY)), "two", 95)
    store.add("t", keys(spark, "cut off"), "lost", 1)
    assert store.tidy("t", ["one", "two"], 100)
    assert store._note("t")["buckets"] == 11
    assert seen(store, spark, ["one", "two"], "1", "99", "cut off", "x") == ["1", "99"]
    attempts = ["one", "two"]
    for i in range(8):  # files of many loads are put together, and only the last two generations stay
        store.add("t", keys(spark, f"k{i}"), f"a{i}", 1)
        attempts.append(f"a{i}")
        store.tidy("t", attempts, 101 + i)
    assert seen(store, spark, attempts, "1", "k0", "k7") == ["1", "k0", "k7"]
    generations = {int(os.path.basename(g).split("=")[1]) for g in glob.glob(str(tmp_path / "keys" / "t" / "generation=*"))}
    assert generations == {store._note("t")["generation"], store._note("t")["generation"] - 1}


@pytest.mark.parametrize("probe, probe_rows, named", [(100, 0, 1000), (0, 0, 0), (100, 10**9, 0)])
def test_loads_with_a_key_store(spark, tmp_path, monkeypatch, probe, probe_rows, named):
    """Two loads that find no store yet, one cut off, and one with new rows; NULL keys, repeated keys and keys of two columns."""
    monkeypatch.setattr(key_stores, "NAMED_KEYS", named)
    warehouse = ParquetWarehouse(spark, str(tmp_path / "wh"), key_rows=0)
    given = inputs(spark, pedidos=DATED)
    first = run_daily(given, warehouse, "d1")
    assert set(run_daily(given, warehouse, "d2", probe=probe, probe_rows=probe_rows).values()) == {0}
    more = INPUTS["usuarios"][1] + [(77, "Eva", "Sol", "e@x", "d", "t"), (77, "Eva", "Sol", "e@x", "d2", "t")]
    places = INPUTS["ubicaciones"][1] + [(50, 3.0, 4.0, DATED[-1][3])]
    later = inputs(spark, pedidos=DATED, usuarios=more, ubicaciones=places)
    warehouse.begin("d3")
    rows = warehouse.unseen("dim_clientes", later["usuarios"], ["cliente_id"], "d3", True, probe, probe_rows)
    warehouse.append("dim_clientes", rows, "d3")  # and no more
    added = run_daily(later, warehouse, "d3", probe=probe, probe_rows=probe_rows)
    assert {t: n for t, n in added.items() if n} == {"dim_clientes": 2, "dim_ubicaciones": 1}
    assert set(run_daily(later, warehouse, "d4", probe=probe, probe_rows=probe_rows).values()) == {0}
    assert warehouse.stored("dim_clientes").count() == first["dim_clientes"] + 2


def test_the_calendar_reads_the_orders_once(spark, tmp_path, monkeypatch):
    """However often its dates are compared and counted."""
    reads = []
    monkeypatch.setattr(daily, "written", lambda df, label: reads.append(label) or written(df, label))
    warehouse, given = ParquetWarehouse(spark, str(tmp_path / "wh"), key_rows=0), inputs(spark, pedidos=DATED)
    first = run_daily(given, warehouse, "d1")
    assert run_daily(given, warehouse, "d2", probe_rows=0)["dim_fecha"] == 0 < first["dim_fecha"]
    assert reads.count("calendar") == 2


def test_a_store_is_made_up_from_earlier_loads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_stores, "NAMED_KEYS", 0)
    root, given = str(tmp_path / "wh"), inputs(spark, pedidos=DATED)
    run_daily(given, ParquetWarehouse(spark, root), "d1")
    assert not os.path.exists(f"{root}/key_store")
    warehouse = ParquetWarehouse(spark, root, key_rows=0)
    assert set(run_daily(given, warehouse, "d2").values()) == {0}
    assert os.path.exists(f"{root}/key_store")
    found = warehouse.unseen("dim_clientes", given["usuarios"], ["cliente_id"], "d3", True, 100, 10**9)
    text = plan(found)
    assert "Bucketed: true" in text and f"{root}/dim_clientes" not in text
    assert found.isEmpty()
