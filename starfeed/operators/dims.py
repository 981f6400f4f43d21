"""The sixteen dimension tables: de-duplicated projections of one source each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from starfeed.functions import calendar_columns, to_day
from starfeed.operators.incremental import PROBE_ROWS, new_rows
from starfeed.workspace import written


@dataclass(frozen=True)
class Dimension:
    """``columns``: source column -> output column; empty passes all columns
    through, with ``renames`` applied where the column exists. ``wide``: rows may hold whole pages."""

    source: str
    columns: Mapping[str, str] = field(default_factory=dict)
    renames: Mapping[str, str] = field(default_factory=dict)
    wide: bool = False


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


# The output tables, their sources and their columns.
DIMENSIONS: dict[str, Dimension] = {
    "dim_clientes": Dimension(
        "usuarios", _same("cliente_id", "nombre", "apellido", "email", "direccion", "telefono")
    ),
    "dim_wallets": Dimension("wallets", renames={"id": "cliente_id"}),
    "dim_productos": Dimension(
        "productos",
        {**_same("producto_id", "catalogo_id"), "nombre_producto": "nombre", **_same("categoria", "precio")},
    ),
    "dim_repartidores": Dimension("repartidores", _same("repartidor_id", "nombre", "estado")),
    "dim_ubicaciones": Dimension("ubicaciones", _same("repartidorId", "latitud", "longitud", "timestamp")),
    "dim_sesiones": Dimension("sesiones", _same("repartidorId", "fecha_inicio", "fecha_expiracion", "activa")),
    "dim_transacciones": Dimension(
        "transacciones",
        _same(
            "id", "origin_user_id", "destination_user_id", "transaction_date", "currency_type", "amount", "concept"
        ),
    ),
    "dim_wallets_blockchain": Dimension("blockchain_wallets"),
    "dim_tenants": Dimension("tenants"),
    "dim_catalogos": Dimension("catalogos"),
    "dim_promociones": Dimension("promociones"),
    "dim_imagenes_producto": Dimension("imagenes_producto", wide=True),
    "dim_datos_contacto": Dimension("datos_contacto"),
    "dim_fecha": Dimension("pedidos", {"fechaCreacion": "fecha"}),
    "dim_ratings": Dimension(
        "ratings",
        {
            "id": "rating_id", "pedidoId": "pedido_id", "repartidorId": "repartidor_id",
            **_same("puntaje", "comentario", "fecha_creacion"),
        },
    ),
    "dim_pedidos_delivery": Dimension("delivery_pedidos"),
}


def project(dimension: Dimension, source: DataFrame) -> DataFrame:
    if not dimension.columns:
        return source.withColumnsRenamed(dict(dimension.renames))
    return source.select(*[F.col(c).alias(out) for c, out in dimension.columns.items()])


def calendar(orders: DataFrame, column: str, day: str) -> DataFrame:
    """The dates on which orders occur, with their parts; unknown dates are left out."""
    days = orders.select(to_day(orders, column).alias(day)).where(F.col(day).isNotNull()).distinct()
    return days.withColumns(calendar_columns(day))


def dimension_rows(name: str, inputs: Mapping[str, DataFrame]) -> DataFrame:
    """The rows of one dimension with their copies; the calendar, a few thousand dates however many orders, has none."""
    dimension = DIMENSIONS[name]
    source = inputs[dimension.source]
    if name == "dim_fecha":
        [(column, day)] = dimension.columns.items()
        return calendar(source, column, day)
    return project(dimension, source)


def whole_rows_once(rows: DataFrame, wide: bool = False) -> DataFrame:
    """Each whole row once. Rows ``wide`` with text are told apart by digests: only digests are shuffled, rows of a digest that occurs once stay
    where they are read, and whole rows are compared, and moved, where digests are equal. ``rows`` are then read three times, so they are best a file."""
    if not wide:
        return rows.dropDuplicates()
    columns = [F.col(f"`{c}`") for c in rows.columns]
    marked = rows.withColumns(digests(columns))
    on = list(digests(columns))
    repeated = marked.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*on)
    repeated = written(repeated, "repeated-digests")
    once = marked.join(repeated, on, "left_anti").select(*columns)
    whole = F.struct(*columns)
    copies = marked.join(repeated, on, "left_semi")
    groups = written(copies.groupBy(*on).agg(F.min(whole).alias("_low"), F.max(whole).alias("_high")), "repeated-rows")
    equal = F.col("_low").eqNullSafe(F.col("_high"))
    result = once.unionByName(groups.where(equal).select("_low.*"))
    clashes = groups.where(~equal).select(*on)
    if not clashes.isEmpty():  # different rows of one digest
        result = result.unionByName(copies.join(clashes, on, "left_semi").select(*columns).dropDuplicates())
    return result


def digests(columns: Sequence[Column]) -> dict[str, Column]:
    """128 bits of a row; which values are NULL counts, too, as hashes pass over those."""
    parts = [F.array(*[c.isNull() for c in columns]), *columns]
    return {"_d1": F.xxhash64(*parts), "_d2": F.xxhash64(F.lit(1), *parts)}


def build_dimension(name: str, inputs: Mapping[str, DataFrame]) -> DataFrame:
    """One dimension from the loaded sources. Whole-row duplicates go; rows that share
    a key but differ elsewhere all stay."""
    rows = dimension_rows(name, inputs)
    return rows if name == "dim_fecha" else whole_rows_once(rows, DIMENSIONS[name].wide)


def new_dimension_rows(
    name: str,
    inputs: Mapping[str, DataFrame],
    stored: DataFrame | None,
    keys: Sequence[str],
    null_safe: bool = True,
    probe: int | None = None,
    probe_rows: int = PROBE_ROWS,
) -> DataFrame:
    """The rows of a dimension whose key is not stored (see ``new_rows``). Known keys go
    before duplicates do, so only new rows are shuffled whole."""
    rows = dimension_rows(name, inputs)
    if name == "dim_fecha":
        return new_rows(rows, stored, keys, null_safe)
    wide = DIMENSIONS[name].wide
    unseen = new_rows(rows, stored, keys, null_safe, probe=probe, probe_rows=probe_rows)
    return whole_rows_once(written(unseen, "unseen-rows") if wide else unseen, wide)
