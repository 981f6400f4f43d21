"""Dimensions and facts on edge rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from fixtures import D0, D1, brief, expected_fact, inputs
from starfeed.functions import to_day
from starfeed.operators import DIMENSIONS, build_dimension, fact_orders, fact_profile, fact_ratings, inputs_after
from starfeed.operators import dims
from starfeed.operators.facts import FACT_ORDER_COLUMNS


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_fact_keeps_every_match(spark):
    fact = fact_orders(inputs(spark))
    assert fact.columns == FACT_ORDER_COLUMNS
    assert brief(fact) == expected_fact()


def test_total_is_the_unit_price(spark):
    prices = {r["total_producto"] for r in fact_orders(inputs(spark)).collect()}
    assert {int(p) for p in prices} == {1, 2}


@pytest.mark.parametrize("probe", [0, 100])
def test_fact_with_every_key_split(spark, probe):
    given = {name: df.coalesce(1) for name, df in inputs(spark).items()}
    profile = fact_profile(given, probe, share=0.02, min_rows=1)
    assert profile.keys("asignaciones", "pedido_id")[1001] > 1
    assert profile.keys("pedido_productos", "pedido_id")[1000] > 1
    assert bool(profile.keys("pedido_productos", "producto_id")) == (probe == 0)
    assert profile.small == (set() if probe == 0 else {"productos", "usuarios", "repartidores"})
    assert brief(fact_orders(given, profile)) == expected_fact()


@pytest.mark.parametrize("probe", [100, 0])
def test_fact_after_a_mark(spark, probe):
    part = inputs_after(inputs(spark), D0, probe)
    assert brief(fact_orders(part)) == [r for r in expected_fact() if r[1] and r[1] > D0]
    assert inputs_after(inputs(spark), None).keys() == inputs(spark).keys()


def test_keys_of_two_types_meet(spark):
    given = inputs(spark)
    given["productos"] = given["productos"].withColumn("producto_id", F.col("producto_id").cast("string"))
    given["usuarios"] = given["usuarios"].withColumn("cliente_id", F.col("cliente_id").cast("double"))
    given["asignaciones"] = given["asignaciones"].withColumn("pedido_id", F.col("pedido_id").cast("int"))
    for probe in (0, 100):
        fact = fact_orders(given, fact_profile(given, probe, share=0.02, min_rows=1))
        assert fact.schema["producto_id"].dataType.simpleString() == "string" and fact.schema["pedido_id"].dataType.simpleString() == "bigint"
        as_before = fact.withColumns({"producto_id": F.col("producto_id").cast("long"), "cliente_id": F.col("cliente_id").cast("long")})
        assert brief(as_before) == expected_fact()
        assert fact_orders(inputs_after(given, D0, probe)).count() == sum(bool(r[1] and r[1] > D0) for r in expected_fact())


def test_orders_of_the_mark_date_are_skipped(spark):
    assert all(r[1] > D1 for r in brief(fact_orders(inputs_after(inputs(spark), D1))))


def test_dimension_drops_copies_and_keeps_variants(spark):
    got = rows(build_dimension("dim_clientes", inputs(spark)))
    assert [r[0] for r in got if r[0]] == [1, 2, 2]
    assert len(got) == 4


def test_wide_rows_are_told_apart_by_digests(spark, tmp_path, monkeypatch):
    rows = [(i % 70, f"http://{i % 70}", "page " * 50 + str(i % 70)) for i in range(100)] + [(None, None, "x"), (None, "x", None), (None, "x", None)]
    spark.createDataFrame(rows, "imagen_id long, url string, html string").write.parquet(str(tmp_path / "t"))
    given = spark.read.parquet(str(tmp_path / "t"))
    got = build_dimension("dim_imagenes_producto", {"imagenes_producto": given})
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, set(rows)))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange" in line and "html" in line]
    monkeypatch.setattr(dims, "digests", lambda columns: {"_d1": F.lit(1), "_d2": F.coalesce(F.col("imagen_id") % 2, F.lit(0))})
    clashing = build_dimension("dim_imagenes_producto", {"imagenes_producto": given})
    assert sorted(map(str, (tuple(r) for r in clashing.collect()))) == sorted(map(str, set(rows)))


def test_renames(spark):
    given = inputs(spark)
    assert build_dimension("dim_wallets", given).columns == ["cliente_id", "saldo"]
    assert build_dimension("dim_productos", given).columns == [
        "producto_id", "catalogo_id", "nombre", "categoria", "precio",
    ]
    no_id = {"wallets": given["wallets"].drop("id")}
    assert build_dimension("dim_wallets", no_id).columns == ["saldo"]


def test_pass_through_keeps_all_columns(spark):
    assert rows(build_dimension("dim_pedidos_delivery", inputs(spark))) == [(1000, "a"), (1001, "b")]


def test_all_sixteen_dimensions_build(spark):
    given = inputs(spark)
    assert len(DIMENSIONS) == 16
    assert all(not build_dimension(name, given).isEmpty() for name in DIMENSIONS)


def test_calendar(spark):
    got = {r["fecha"]: r for r in build_dimension("dim_fecha", inputs(spark)).collect()}
    assert set(got) == {date(2024, 3, 30), date(2024, 3, 31), date(2024, 4, 1)}
    sunday = got[date(2024, 3, 31)]
    assert tuple(sunday)[1:] == (2024, 3, 31, 1, "March", "Sunday", 1)


def test_text_dates(spark):
    df = spark.createDataFrame([("2024-03-31",), ("nope",), (None,)], "t string")
    assert [r[0] for r in df.select(to_day(df, "t")).collect()] == [date(2024, 3, 31), None, None]


def test_rating_fact_equals_dimension(spark):
    given = inputs(spark)
    assert rows(fact_ratings(given)) == rows(build_dimension("dim_ratings", given))
    assert fact_ratings(given).columns[:3] == ["rating_id", "pedido_id", "repartidor_id"]


def test_no_python_and_no_product_in_the_fact_plan(spark):
    plan = fact_orders(inputs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_mark_reaches_the_scan(spark, tmp_path):
    inputs(spark)["pedidos"].write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    cut = stored.where(to_day(stored, "fechaCreacion") > F.lit(D0))
    assert "GreaterThanOrEqual(fechaCreacion" in cut._jdf.queryExecution().executedPlan().toString()
