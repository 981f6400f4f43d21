"""What the daily load writes, in order, and how it tells new rows from stored ones."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LoadStep:
    """``keys``: load rows whose key is not stored. ``literal_keys``: the same for the
    literal mode, where an empty tuple appends the whole table each time."""

    table: str
    keys: tuple[str, ...]
    literal_keys: tuple[str, ...]


def _step(table: str, key: str) -> LoadStep:
    return LoadStep(table, (key,), (key,))


# Tables, their order and their keys.
LOAD_PLAN: tuple[LoadStep, ...] = (
    _step("dim_clientes", "cliente_id"),
    LoadStep("dim_wallets", ("cliente_id",), ()),
    _step("dim_productos", "producto_id"),
    _step("dim_repartidores", "repartidor_id"),
    LoadStep("dim_ubicaciones", ("repartidorId", "timestamp"), ("repartidorId",)),
    LoadStep("dim_sesiones", ("repartidorId", "fecha_inicio"), ("repartidorId",)),
    _step("dim_transacciones", "id"),
    _step("dim_wallets_blockchain", "id"),
    _step("dim_tenants", "tenant_id"),
    _step("dim_catalogos", "catalogo_id"),
    _step("dim_promociones", "promocion_id"),
    _step("dim_imagenes_producto", "imagen_id"),
    _step("dim_datos_contacto", "contacto_id"),
    _step("dim_fecha", "fecha"),
    LoadStep("dim_ratings", ("rating_id",), ()),
    _step("dim_pedidos_delivery", "pedido_id"),
)
RATING_FACT = _step("fact_ratings", "rating_id")
ORDER_FACT = "fact_pedidos"
ORDER_FACT_DAY = "fecha_pedido"
ORDER_FACT_PAIR = ("pedido_id", "producto_id")
