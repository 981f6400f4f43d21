"""Daily loads into Parquet and into an embedded database."""

import pytest
from pyspark.sql import functions as F

from fixtures import D1, D2, T2, INPUTS, brief, expected_fact, inputs
from starfeed.operators import fact_orders
from starfeed.plans import LOAD_PLAN, run_daily
from starfeed.sinks import JdbcWarehouse, ParquetWarehouse
from starfeed.sources import Database

TABLES = [s.table for s in LOAD_PLAN] + ["fact_pedidos", "fact_ratings"]
DATED = [r for r in INPUTS["pedidos"][1] if r[3]]


@pytest.fixture
def database(tmp_path):
    return Database(
        f"jdbc:derby:{tmp_path}/db;create=true",
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
        lookup="select TABLENAME from SYS.SYSTABLES where TABLENAME = upper('{table}')",
    )


@pytest.fixture(params=["parquet", "jdbc"])
def warehouse(request, spark, tmp_path, database):
    if request.param == "parquet":
        return ParquetWarehouse(spark, str(tmp_path / "wh"))
    return JdbcWarehouse(spark, database)


def counts(warehouse):
    return {t: warehouse.stored(t).count() for t in TABLES}


@pytest.mark.parametrize("probe_rows", [0, 1_000_000])
def test_two_loads_equal_one(spark, warehouse, probe_rows):
    given = inputs(spark, pedidos=DATED)
    first = run_daily(given, warehouse, "d1")
    assert list(first) == TABLES
    assert counts(warehouse) == first
    assert brief(warehouse.stored("fact_pedidos")) == [r for r in expected_fact() if r[1]]
    second = run_daily(given, warehouse, "d2", probe_rows=probe_rows)
    assert set(second.values()) == {0}
    assert counts(warehouse) == first


def test_steps_equal_one_load(spark, warehouse, tmp_path):
    early = [r for r in DATED if r[3] < T2]
    run_daily(inputs(spark, pedidos=early), warehouse, "d1")
    assert warehouse.mark("fact_pedidos", "fecha_pedido") == D1
    run_daily(inputs(spark, pedidos=DATED), warehouse, "d2")
    whole = ParquetWarehouse(spark, str(tmp_path / "whole"))
    run_daily(inputs(spark, pedidos=DATED), whole, "d1")
    for table in TABLES:
        a, b = warehouse.stored(table), whole.stored(table)
        assert set(a.columns) == set(b.columns)
        assert sorted(map(str, a.select(b.columns).collect())) == sorted(map(str, b.collect())), table


def test_lookback_adds_late_orders_only(spark, warehouse):
    late = [r for r in DATED if r[0] != 1000]
    run_daily(inputs(spark, pedidos=late), warehouse, "d1")
    assert run_daily(inputs(spark, pedidos=DATED), warehouse, "d2")["fact_pedidos"] == 0
    added = run_daily(inputs(spark, pedidos=DATED), warehouse, "d3", lookback_days=10)
    assert added["fact_pedidos"] == 6
    assert brief(warehouse.stored("fact_pedidos")) == [r for r in expected_fact() if r[1]]


def test_literal_mode(spark, tmp_path):
    warehouse = ParquetWarehouse(spark, str(tmp_path))
    more = INPUTS["ubicaciones"][1] + [(50, 9.0, 9.0, T2), (52, 1.0, 1.0, T2)]
    run_daily(inputs(spark, pedidos=DATED), warehouse, "d1", literal=True)
    again = run_daily(inputs(spark, pedidos=DATED, ubicaciones=more), warehouse, "d2", literal=True)
    changed = {t: n for t, n in again.items() if n}
    # whole tables again; a NULL key again; only the new driver's location
    assert changed == {
        "dim_clientes": 1, "dim_wallets": 2, "dim_ubicaciones": 1, "dim_imagenes_producto": 1, "dim_ratings": 2,
    }
    assert run_daily(inputs(spark, pedidos=DATED, ubicaciones=more), warehouse, "d3")["dim_ubicaciones"] == 1


def test_undated_orders_load_without_a_mark_only(spark, tmp_path):
    warehouse = ParquetWarehouse(spark, str(tmp_path))
    run_daily(inputs(spark), warehouse, "d1")
    assert brief(warehouse.stored("fact_pedidos")) == expected_fact()
    assert run_daily(inputs(spark), warehouse, "d2")["fact_pedidos"] == 0
    assert warehouse.stored("fact_pedidos", after=D1).where(F.col("fecha_pedido") != D2).isEmpty()


def test_a_load_cut_off_is_invisible_and_repeatable(spark, tmp_path):
    warehouse = ParquetWarehouse(spark, str(tmp_path))
    given = inputs(spark, pedidos=DATED)
    warehouse.append("fact_pedidos", fact_orders(given).limit(3), "d1")
    assert warehouse.stored("fact_pedidos") is None
    assert warehouse.mark("fact_pedidos", "fecha_pedido") is None
    added = run_daily(given, warehouse, "d1")
    assert brief(warehouse.stored("fact_pedidos")) == [r for r in expected_fact() if r[1]]
    with pytest.raises(ValueError, match="finished"):
        run_daily(given, warehouse, "d1")
    assert counts(warehouse) == added


def test_fact_is_pruned_by_month(spark, tmp_path):
    warehouse = ParquetWarehouse(spark, str(tmp_path))
    run_daily(inputs(spark, pedidos=DATED), warehouse, "d1")
    plan = warehouse.stored("fact_pedidos", after=D1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(anio_mes" in plan


def cut_off(monkeypatch, warehouse, after):
    """Makes the warehouse stop once ``after`` is half written."""
    append = warehouse.append

    def stops(table, df, load_id):
        if table != after:
            return append(table, df, load_id)
        append(table, df.limit(max(1, df.count() // 2)), load_id)
        raise RuntimeError("no room")

    monkeypatch.setattr(warehouse, "append", stops)


def same_tables(a, b):
    for table in TABLES:
        x, y = a.stored(table), b.stored(table)
        assert sorted(map(str, x.select(sorted(x.columns)).collect())) == sorted(map(str, y.select(sorted(x.columns)).collect())), table


@pytest.mark.parametrize(
    "table, options",
    [("dim_clientes", {}), ("fact_pedidos", {}), ("fact_ratings", {"literal": True}), ("fact_pedidos", {"lookback_days": 10})],
)
def test_a_load_cut_off_ends_like_an_undisturbed_one(spark, tmp_path, database, monkeypatch, table, options):
    """Repeated keys in the dimensions, an order whose state changes between the tries, and late orders."""
    warehouse, whole = JdbcWarehouse(spark, database), ParquetWarehouse(spark, str(tmp_path / "whole"))
    early = inputs(spark, pedidos=[r for r in DATED if r[0] != 1000 and r[3] < T2])
    changed = [(*r[:2], "LISTO", *r[3:]) for r in DATED]
    for w in (warehouse, whole):
        run_daily(early, w, "d1", **options)
    with monkeypatch.context() as patch:
        cut_off(patch, warehouse, table)
        with pytest.raises(RuntimeError, match="no room"):
            run_daily(inputs(spark, pedidos=DATED), warehouse, "d2", **options)
    assert len(warehouse.unfinished()) == 1
    assert warehouse.mark("fact_pedidos", "fecha_pedido") == whole.mark("fact_pedidos", "fecha_pedido")
    for w in (warehouse, whole):
        run_daily(inputs(spark, pedidos=changed), w, "d2", **options)
        with pytest.raises(ValueError, match="finished"):
            run_daily(inputs(spark, pedidos=changed), w, "d2", **options)
    same_tables(warehouse, whole)


def test_the_mark_opens_no_data_file(spark, tmp_path, monkeypatch):
    warehouse = ParquetWarehouse(spark, str(tmp_path))
    run_daily(inputs(spark, pedidos=DATED), warehouse, "d1")
    monkeypatch.setattr(warehouse, "_read", lambda table: pytest.fail("reads the table"))
    assert warehouse.mark("fact_pedidos", "fecha_pedido") == D2


def test_jdbc_reads(spark, database):
    df = spark.range(100).select(F.col("id").alias("clave"), F.lit("a").alias("t"))
    assert not database.exists(spark, "tabla")
    assert database.append(df, "tabla") == 100
    assert database.exists(spark, "tabla")
    assert tuple(database.largest(spark, "tabla", "clave")) == (99, 100)
    split = database.read(spark, "tabla", ["clave"], split_on="clave", partitions=4)
    assert split.select(F.spark_partition_id()).distinct().count() == 4
    assert sorted(r[0] for r in split.collect()) == list(range(100))
    database.append(df.select("clave").limit(1), "tabla")  # a missing column is NULL
    assert database.read(spark, "tabla").where("t is null").count() == 1
    with pytest.raises(Exception):
        database.append(df.withColumn("otra", F.lit(1)), "tabla")


def test_a_broken_connection_is_not_a_missing_table(spark, tmp_path):
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    gone = Database(f"jdbc:derby:{tmp_path}/none", driver=driver, lookup="values 1")
    with pytest.raises(Exception):
        JdbcWarehouse(spark, gone).mark("fact_pedidos", "fecha_pedido")
