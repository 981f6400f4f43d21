"""The eighteen operational extracts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T

from starfeed.sources.csv import read_csv

#: Extracts that are sized up or landed side by side, so that a small one in few files does not keep the others waiting.
AT_A_TIME = 4
LONG, INT, TEXT, REAL = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()
TIME, FLAG = T.TimestampType(), T.BooleanType()


@dataclass(frozen=True)
class Source:
    """One extract: its file, the types its known raw columns have if all values fit them (see
    ``read_csv``), the names the star schema uses instead, and whether a text field may hold line breaks."""

    file: str
    columns: Mapping[str, T.DataType]
    renames: Mapping[str, str] = field(default_factory=dict)
    multi_line: bool = True


# Dataset names, file names, raw column names and the names given on reading.
SOURCES: dict[str, Source] = {
    "usuarios": Source(
        "cliente_users",
        {"id": LONG, "nombre": TEXT, "apellido": TEXT, "email": TEXT, "direccion": TEXT, "telefono": TEXT},
        {"id": "cliente_id"},
    ),
    "wallets": Source("cliente_wallets", {"id": LONG}),
    "productos": Source(
        "marketplace_productos",
        {"producto_id": LONG, "catalogo_id": LONG, "nombre_producto": TEXT, "categoria": TEXT, "precio": REAL},
    ),
    "pedidos": Source(
        "cliente_pedidos",
        {
            "id": LONG, "user": LONG, "estado": TEXT, "fechaCreacion": TIME, "metodoPago": TEXT,
            "tenant_id": LONG, "calificacion": REAL, "comentario": TEXT, "tiempo_entrega_min": INT,
        },
        {"id": "pedido_id", "user": "cliente_id_pedido", "estado": "estado_pedido"},
    ),
    "pedido_productos": Source(
        "cliente_pedido_productos",
        {"pedido_id": LONG, "producto_id": LONG, "precio_unitario": REAL},
        multi_line=False,
    ),
    "asignaciones": Source(
        "delivery_asignaciones", {"pedidoId": LONG, "repartidorId": LONG}, {"pedidoId": "pedido_id"}, multi_line=False
    ),
    "repartidores": Source(
        "delivery_repartidores", {"id": LONG, "nombre": TEXT, "estado": TEXT}, {"id": "repartidor_id"}
    ),
    "ubicaciones": Source(
        "delivery_ubicaciones",
        {"repartidorId": LONG, "latitud": REAL, "longitud": REAL, "timestamp": TIME},
        multi_line=False,
    ),
    "sesiones": Source(
        "delivery_sesiones",
        {"repartidorId": LONG, "fecha_inicio": TIME, "fecha_expiracion": TIME, "activa": FLAG},
        multi_line=False,
    ),
    "ratings": Source(
        "delivery_ratings",
        {
            "id": LONG, "pedidoId": LONG, "repartidorId": LONG, "puntaje": INT,
            "comentario": TEXT, "fecha_creacion": TIME,
        },
    ),
    "delivery_pedidos": Source("delivery_pedidos", {"pedido_id": LONG}),
    "transacciones": Source(
        "blockchain_transactions",
        {
            "id": LONG, "origin_user_id": LONG, "destination_user_id": LONG, "transaction_date": TIME,
            "currency_type": TEXT, "amount": REAL, "concept": TEXT,
        },
    ),
    "blockchain_wallets": Source("blockchain_wallets", {"id": LONG}),
    "tenants": Source("marketplace_tenants", {"tenant_id": LONG}),
    "catalogos": Source("marketplace_catalogos", {"catalogo_id": LONG}),
    "promociones": Source("marketplace_promociones", {"promocion_id": LONG}),
    "imagenes_producto": Source("marketplace_imagenes_producto", {"imagen_id": LONG}),
    "datos_contacto": Source("marketplace_datos_contacto", {"contacto_id": LONG}),
}


def source_path(base: str, name: str, folders: bool = False) -> str:
    """``<base>/<area>_<entity>.csv``, or ``<base>/<area>/<entity>.csv`` with
    ``folders``. ``base`` is any address Spark can read; the path may be one file
    or a folder of part files."""
    file = SOURCES[name].file
    if folders:
        file = file.replace("_", "/", 1)
    return f"{base.rstrip('/')}/{file}.csv"


def load_sources(
    spark: SparkSession,
    base: str,
    names: Iterable[str] = tuple(SOURCES),
    folders: bool = False,
    extra_types: Mapping[str, Mapping[str, T.DataType]] | None = None,
    splittable: Iterable[str] = (),
) -> dict[str, DataFrame]:
    """Read the named extracts, with their columns renamed.

    ``extra_types`` declares pass-through columns per dataset. Datasets listed in
    ``splittable`` hold no line breaks inside fields and are read in parallel
    pieces even when they are one big file.
    """
    whole, names = set(splittable), list(names)

    def read(name: str) -> DataFrame:
        return read_csv(
            spark,
            source_path(base, name, folders),
            {**SOURCES[name].columns, **(extra_types or {}).get(name, {})},
            multi_line=SOURCES[name].multi_line and name not in whole,
        ).withColumnsRenamed(dict(SOURCES[name].renames))

    with ThreadPoolExecutor(AT_A_TIME) as pool:
        return dict(zip(names, pool.map(read, names)))


def land(inputs: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Write each input once as Parquet below ``folder`` and read it back, so that
    the many tables built from it do not parse the CSV again."""

    def landed(name: str) -> DataFrame:
        df, path = inputs[name], f"{folder.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    with ThreadPoolExecutor(AT_A_TIME) as pool:
        return dict(zip(inputs, pool.map(landed, inputs)))
