"""Small raw inputs with every edge row of the data model."""

from datetime import date, datetime
from decimal import Decimal

T0, T1, T2 = datetime(2024, 3, 30, 10), datetime(2024, 3, 31, 23, 59), datetime(2024, 4, 1)

# (columns as DDL, rows), names as after reading
INPUTS = {
    "usuarios": (
        "cliente_id long, nombre string, apellido string, email string, direccion string, telefono string",
        [
            (1, "Ana", "Paz", "a@x", "d1", "t1"),
            (1, "Ana", "Paz", "a@x", "d1", "t1"),  # whole-row copy
            (2, "Luz", "Rey", "l@x", "d2", "t2"),
            (2, "Luz", "Rey", "l@x", "d2 bis", "t2"),  # same key, other address
            (None, "Sin", "Clave", None, None, None),
        ],
    ),
    "wallets": ("id long, saldo double", [(1, 5.0), (1, 5.0), (2, None)]),
    "productos": (
        "producto_id long, catalogo_id long, nombre_producto string, categoria string, precio decimal(18,2)",
        [(10, 100, "pan", "c", 1), (11, 101, "sal", "c", 2)],
    ),
    "pedidos": (
        "pedido_id long, cliente_id_pedido long, estado_pedido string, fechaCreacion timestamp, metodoPago string, "
        "tenant_id long, calificacion double, comentario string, tiempo_entrega_min int",
        [
            (1000, 1, "OK", T0, "CRIPTO", 1, 4.5, "bien", 30),
            (1001, 2, "OK", T1, None, 1, None, None, None),  # no payment; two assignments
            (1002, 1, "OK", T2, "EFECTIVO", 2, 3.0, "", 10),  # no assignment
            (1003, 9, "OK", T2, "CRIPTO", 2, 3.0, "x", 10),  # unknown customer
            (1004, 1, "OK", None, "CRIPTO", 2, 3.0, "x", 10),  # no date
            (1005, None, "OK", T2, "CRIPTO", 2, 3.0, "x", 10),  # no customer
        ],
    ),
    "pedido_productos": (
        "pedido_id long, producto_id long, precio_unitario decimal(18,2)",
        [
            (1000, 10, 1), (1000, 11, 2), (1000, 11, 2),  # a line twice
            (1001, 10, 1), (1002, 10, 1), (1003, 10, 1), (1004, 10, 1), (1005, 10, 1),
            (7777, 10, 1),  # no order
            (1000, 99, 1),  # no product
            (None, 10, 1), (1000, None, 1),
        ],
    ),
    "asignaciones": (
        "pedido_id long, repartidorId long",
        [(1000, 50), (1001, 51), (1001, 59), (1004, None), (None, 50)],  # 59: unknown driver
    ),
    "repartidores": (
        "repartidor_id long, nombre string, estado string",
        [(50, "R", "A"), (51, "S", "A"), (51, "S", "B")],  # driver 51 twice
    ),
    "ubicaciones": (
        "repartidorId long, latitud double, longitud double, timestamp timestamp",
        [(50, 1.0, 2.0, T0), (50, 1.5, 2.0, T1), (51, 0.0, 0.0, T0), (51, 0.0, 0.0, T0)],
    ),
    "sesiones": (
        "repartidorId long, fecha_inicio timestamp, fecha_expiracion timestamp, activa boolean",
        [(50, T0, T1, True), (50, T1, T2, False)],
    ),
    "ratings": (
        "id long, pedidoId long, repartidorId long, puntaje int, comentario string, fecha_creacion timestamp",
        [(1, 1000, 50, 5, "ok", T0), (2, 1001, 51, 1, None, T1)],
    ),
    "delivery_pedidos": ("pedido_id long, extra string", [(1000, "a"), (1000, "a"), (1001, "b")]),
    "transacciones": (
        "id long, origin_user_id long, destination_user_id long, transaction_date timestamp, currency_type string, "
        "amount decimal(18,2), concept string",
        [(1, 1, 2, T0, "BTC", 3, "pago")],
    ),
    "blockchain_wallets": ("id long, extra string", [(1, "w"), (2, None)]),
    "tenants": ("tenant_id long, extra string", [(1, "t")]),
    "catalogos": ("catalogo_id long, extra string", [(100, "c")]),
    "promociones": ("promocion_id long, extra string", [(1, "p")]),
    "imagenes_producto": ("imagen_id long, extra string", [(1, "i"), (None, "i")]),
    "datos_contacto": ("contacto_id long, extra string", [(1, "d")]),
}

D0, D1, D2 = date(2024, 3, 30), date(2024, 3, 31), date(2024, 4, 1)

# pedido, day, customer, product, catalogue, driver, crypto
FACT = [
    (1000, D0, 1, 10, 100, 50, True),
    (1000, D0, 1, 11, 101, 50, True),
    (1000, D0, 1, 11, 101, 50, True),
    (1001, D1, 2, 10, 100, 51, False),
    (1001, D1, 2, 10, 100, 59, False),
    (1002, D2, 1, 10, 100, None, False),
    (1004, None, 1, 10, 100, None, True),
]


def expected_fact():
    """Customers 1 and 2 and driver 51 occur twice, and each copy counts."""
    rows = []
    for row in FACT:
        rows += [row] * 2 * (2 if row[5] == 51 else 1)
    return sorted(rows, key=str)


def inputs(spark, **changed):
    out = {}
    for name, (columns, rows) in INPUTS.items():
        rows = changed.get(name, rows)
        if "decimal" in columns:
            at = [i for i, c in enumerate(columns.replace("(18,2)", "").split(",")) if "decimal" in c]
            rows = [tuple(Decimal(v) if i in at else v for i, v in enumerate(r)) for r in rows]
        out[name] = spark.createDataFrame(rows, columns)
    return out


def brief(fact):
    keep = ["pedido_id", "fecha_pedido", "cliente_id", "producto_id", "catalogo_id", "repartidor_id", "es_cripto"]
    return sorted((tuple(r) for r in fact.select(keep).collect()), key=str)
