"""The two fact tables."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, functions as F

from starfeed.functions import paid_in_crypto, to_day
from starfeed.operators.dims import build_dimension
from starfeed.operators.incremental import BROADCAST_KEYS, after_mark, in_one_type, key_set, written_with_keys
from starfeed.operators.skew import Hot, hot_keys, skew_join
from starfeed.workspace import written

# The columns of the order fact.
FACT_ORDER_COLUMNS = [
    "pedido_id", "fecha_pedido", "cliente_id", "producto_id", "catalogo_id", "repartidor_id", "metodoPago",
    "estado", "es_cripto", "total_producto", "tenant_id", "calificacion", "comentario", "tiempo_entrega_min",
]


# The inputs of the order fact and the columns they are joined on: the large ones first,
# then the dimensions with the large input and column that refer to them.
LARGE = {
    "pedido_productos": ["pedido_id"],
    "pedidos": ["pedido_id"],
    "asignaciones": ["pedido_id"],
}
DIMENSION_KEYS = {
    "productos": ("producto_id", "pedido_productos", "producto_id"),
    "usuarios": ("cliente_id", "pedidos", "cliente_id_pedido"),
    "repartidores": ("repartidor_id", "asignaciones", "repartidorId"),
}
FACT_INPUTS = (*LARGE, *DIMENSION_KEYS)
# The columns that are joined: what an extract takes for a number, another may take for text.
JOINED = (
    [(name, "pedido_id") for name in LARGE],
    *[[(name, key), (referrer, column)] for name, (key, referrer, column) in DIMENSION_KEYS.items()],
)
# The columns the fact takes from the inputs cut down by order id.
FACT_PARTS = {"pedido_productos": ["producto_id", "precio_unitario"], "asignaciones": ["repartidorId"]}


@dataclass(frozen=True)
class FactProfile:
    """What the join plan of the order fact depends on: the dimensions small enough to
    broadcast, and the hot keys of each input (input -> column -> keys)."""

    small: frozenset[str] = frozenset()
    hot: Mapping[str, Mapping[str, Hot]] = field(default_factory=dict)

    def keys(self, name: str, column: str) -> Hot:
        return self.hot.get(name, {}).get(column, {})

    def tag(self, name: str) -> str | None:
        """The row tag an input needs to be split, if it has hot keys."""
        return f"_row_{name}" if any(self.hot.get(name, {}).values()) else None


def with_joinable_keys(inputs: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The inputs with each key in one type wherever it occurs; as they are where the types agree."""
    out = dict(inputs)
    for places in JOINED:
        names, columns = zip(*places)
        out.update(zip(names, in_one_type([out[n] for n in names], columns)))
    return out


def small_dimensions(inputs: Mapping[str, DataFrame], probe: int = BROADCAST_KEYS) -> frozenset[str]:
    """The dimensions that may be broadcast, after counting them, all at a time."""

    def is_small(name: str) -> bool:
        columns = ["producto_id", "catalogo_id"] if name == "productos" else [DIMENSION_KEYS[name][0]]
        return key_set(inputs[name].select(*columns), probe).few

    with ThreadPoolExecutor(len(DIMENSION_KEYS)) as pool:
        return frozenset(n for n, yes in zip(DIMENSION_KEYS, pool.map(is_small, DIMENSION_KEYS)) if yes)


def fact_profile(
    inputs: Mapping[str, DataFrame], probe: int = BROADCAST_KEYS, small: frozenset[str] | None = None, **limits: Any
) -> FactProfile:
    """Size up the dimensions, unless ``small`` names those to broadcast, then look for hot keys on the columns that
    will be shuffled (see ``hot_keys``); several inputs at a time."""
    inputs = with_joinable_keys(inputs)
    with ThreadPoolExecutor(len(FACT_INPUTS)) as pool:
        counted = pool.map(lambda name: inputs[name].count(), LARGE)
        small = small_dimensions(inputs, probe) if small is None else small
        rows = dict(zip(LARGE, counted))
        shuffled = {name: list(columns) for name, columns in LARGE.items()}
        for name, (key, referrer, column) in DIMENSION_KEYS.items():
            if name not in small:
                shuffled[name] = [key]
                shuffled[referrer].append(column)
        found = pool.map(lambda n: hot_keys(inputs[n], shuffled[n], rows=rows.get(n), **limits), shuffled)
        return FactProfile(small, dict(zip(shuffled, found)))


def inputs_after(inputs: Mapping[str, DataFrame], mark: Any, probe: int = BROADCAST_KEYS) -> dict[str, DataFrame]:
    """The inputs of the order fact cut down to orders dated after the mark.

    The new orders are written out and their ids counted. Lines and assignments are cut
    to these ids (see ``KeySet.cut``) and written out, too: a daily run scans the
    history once. Up to ``probe`` ids are broadcast, and then none of the history is shuffled;
    beyond that its narrow rows are shuffled once.
    """
    if mark is None:
        return dict(inputs)
    inputs = with_joinable_keys(inputs)
    pedidos = inputs["pedidos"]
    day = "_day"
    new = after_mark(pedidos.withColumn(day, to_day(pedidos, "fechaCreacion")), day, mark).drop(day)
    orders, ids = written_with_keys(new, "new-orders", "pedido_id", probe)
    cut = {**inputs, "pedidos": orders}

    def slice_of(name: str) -> DataFrame:
        columns = inputs[name].select("pedido_id", *FACT_PARTS[name])
        return written(ids.cut(columns), f"new-{name}")

    with ThreadPoolExecutor(len(FACT_PARTS)) as pool:
        return {**cut, **dict(zip(FACT_PARTS, pool.map(slice_of, FACT_PARTS)))}


def fact_orders(inputs: Mapping[str, DataFrame], profile: FactProfile = FactProfile()) -> DataFrame:
    """Order lines with their order, product, customer and assigned driver.

    One row per line x order x product x customer x assignment x driver that match:
    lines need an order, product and customer; an order without assignment stays,
    with a NULL driver; an assignment to an unknown driver keeps its id. Nothing is
    de-duplicated. ``total_producto`` is the unit price of the line.

    The narrow line rows meet the products before the wide order rows, so order text
    is shuffled at order grain only, and orders, assignments and lines meet on one
    shared partitioning by order. An input for which ``profile`` names hot keys is written out with a number
    for each row, which tells its rows apart in the same way when a lost task is run again. Keys that are numbers in one
    input and text in another are compared as text, and stay text.
    """
    inputs = with_joinable_keys(inputs)
    pedidos = inputs["pedidos"]
    columns = {
        "pedido_productos": ["pedido_id", "producto_id", F.col("precio_unitario").alias("total_producto")],
        "pedidos": [
            "pedido_id",
            F.col("cliente_id_pedido").alias("cliente_id"),
            to_day(pedidos, "fechaCreacion").alias("fecha_pedido"),
            "metodoPago",
            F.col("estado_pedido").alias("estado"),
            paid_in_crypto("metodoPago").alias("es_cripto"),
            "tenant_id",
            "calificacion",
            "comentario",
            "tiempo_entrega_min",
        ],
        "asignaciones": ["pedido_id", F.col("repartidorId").alias("repartidor_id")],
        "productos": ["producto_id", "catalogo_id"],
        "usuarios": ["cliente_id"],
        "repartidores": ["repartidor_id"],
    }
    tables = {name: _tagged(inputs[name].select(*columns[name]), profile.tag(name)) for name in FACT_INPUTS}

    def with_dimension(name: str, how: str = "inner") -> DataFrame:
        key, referrer, column = DIMENSION_KEYS[name]
        if name in profile.small:
            return skew_join(tables[referrer], F.broadcast(tables[name]), key, how)
        return skew_join(
            tables[referrer],
            tables[name],
            key,
            how,
            left_hot=profile.keys(referrer, column),
            right_hot=profile.keys(name, key),
            left_tag=profile.tag(referrer),
            right_tag=profile.tag(name),
        )

    priced, bought, driven = (
        with_dimension("productos"), with_dimension("usuarios"), with_dimension("repartidores", "left"),
    )
    placed = skew_join(
        bought,
        driven,
        "pedido_id",
        "left",
        left_hot=profile.keys("pedidos", "pedido_id"),
        right_hot=profile.keys("asignaciones", "pedido_id"),
        left_tag=profile.tag("pedidos"),
        right_tag=profile.tag("asignaciones"),
    )
    fact = skew_join(
        priced,
        placed,
        "pedido_id",
        left_hot=profile.keys("pedido_productos", "pedido_id"),
        right_hot={**profile.keys("pedidos", "pedido_id"), **profile.keys("asignaciones", "pedido_id")},
        left_tag=profile.tag("pedido_productos"),
    )
    return fact.select(*FACT_ORDER_COLUMNS)


def _tagged(df: DataFrame, tag: str | None) -> DataFrame:
    return df if tag is None else written(df.withColumn(tag, F.monotonically_increasing_id()), "tagged")


def fact_ratings(inputs: Mapping[str, DataFrame]) -> DataFrame:
    """The ratings at their own grain: the rows of the ratings dimension."""
    return build_dimension("dim_ratings", inputs)
