"""The eighteen inputs, derived from the benchmark's Parquet tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F


# The columns of the benchmark tables in use.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table by its declared columns, so that no file is opened before the query runs."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def returned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    return lines.select(F.col("l_orderkey").alias("pedido_id"), F.col("l_suppkey").alias("repartidorId"))


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most one driver per order."""
    return returned_lines(spark, sf_dir).groupBy("pedido_id").agg(F.min("repartidorId").alias("repartidorId"))


def all_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every driver of an order: fans the order's lines out."""
    return returned_lines(spark, sf_dir).distinct()


def _usuarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select(
        F.col("c_custkey").alias("cliente_id"),
        F.col("c_name").alias("nombre"),
        F.col("c_mktsegment").alias("apellido"),
        F.concat(F.lower("c_mktsegment"), F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("direccion"),
        F.col("c_nationkey").cast("string").alias("telefono"),
    )


# input -> (table, row condition or None, columns as SQL expressions or ["*"])
_PROJECTIONS = {
    "wallets": ("customer", None, ["c_custkey as id", "c_acctbal as saldo", "c_name", "c_nationkey", "c_mktsegment"]),
    "productos": (
        "part", None,
        ["p_partkey as producto_id", "p_brand as catalogo_id", "p_name as nombre_producto",
         "p_type as categoria", "p_retailprice as precio"],
    ),
    "pedidos": (
        "orders", None,
        ["o_orderkey as pedido_id", "o_custkey as cliente_id_pedido", "o_orderstatus as estado_pedido",
         "o_orderdate as fechaCreacion",
         "case when o_orderpriority = '1-URGENT' then 'CRIPTO' else o_orderpriority end as metodoPago",
         "o_custkey % 5 as tenant_id", "o_totalprice as calificacion", "o_orderpriority as comentario",
         "cast(o_orderkey % 60 as int) as tiempo_entrega_min"],
    ),
    "pedido_productos": (
        "lineitem", None,
        ["l_orderkey as pedido_id", "l_partkey as producto_id", "l_extendedprice as precio_unitario"],
    ),
    "repartidores": (
        "supplier", "s_acctbal > 5000",
        ["s_suppkey as repartidor_id", "s_name as nombre",
         "case when s_acctbal > 7500 then 'ACTIVO' else 'INACTIVO' end as estado"],
    ),
    "ubicaciones": (
        "events", None,
        ["user_id as repartidorId", "value as latitud", "cast(event_id as double) as longitud", "ts as timestamp"],
    ),
    "sesiones": (
        "events", "event_type = 'signup'",
        ["user_id as repartidorId", "ts as fecha_inicio", "ts + interval '30' minute as fecha_expiracion",
         "value > 50 as activa"],
    ),
    "ratings": (
        "events", "event_type = 'view'",
        ["event_id as id", "event_id % 15000 as pedidoId", "user_id % 100 as repartidorId",
         "cast(event_id % 5 + 1 as int) as puntaje", "props as comentario", "ts as fecha_creacion"],
    ),
    "delivery_pedidos": (
        "orders", None,
        ["o_orderkey as pedido_id", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    ),
    "transacciones": (
        "events", "event_type = 'purchase'",
        ["event_id as id", "user_id as origin_user_id", "(user_id * 7) % 100 as destination_user_id",
         "ts as transaction_date", "case when event_id % 2 = 0 then 'BTC' else 'ARS' end as currency_type",
         "value as amount", "event_type as concept"],
    ),
    "blockchain_wallets": (
        "supplier", None, ["s_suppkey as id", "s_name", "s_nationkey", "s_acctbal"],
    ),
    "tenants": ("region", None, ["r_regionkey as tenant_id", "r_name"]),
    "catalogos": ("nation", None, ["n_nationkey as catalogo_id", "n_name", "n_regionkey"]),
    "promociones": (
        "part", None,
        ["p_partkey as promocion_id", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    ),
    "imagenes_producto": ("pages", None, ["page_id as imagen_id", "url", "html"]),
    "datos_contacto": (
        "supplier", None, ["s_suppkey as contacto_id", "s_name", "s_nationkey", "s_acctbal"],
    ),
}
INPUTS = ("usuarios", "asignaciones", *_PROJECTIONS)


def load(spark: SparkSession, sf_dir: str, names: Iterable[str] = INPUTS) -> dict[str, DataFrame]:
    """The named inputs, with the names the star schema uses."""
    inputs = {}
    for name in names:
        if name == "usuarios":
            inputs[name] = _usuarios(spark, sf_dir)
        elif name == "asignaciones":
            inputs[name] = assignments(spark, sf_dir)
        else:
            source, condition, columns = _PROJECTIONS[name]
            df = table(spark, sf_dir, source)
            inputs[name] = (df if condition is None else df.where(condition)).selectExpr(*columns)
    return inputs
