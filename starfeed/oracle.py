"""DuckDB statements that give the same results as the queries of the registry."""

from __future__ import annotations

USUARIOS = """
  select c_custkey as cliente_id, c_name as nombre, c_mktsegment as apellido,
         lower(c_mktsegment) || '@example.com' as email, n_name as direccion,
         cast(c_nationkey as varchar) as telefono
  from customer join nation on c_nationkey = n_nationkey"""
REPARTIDORES = """
  select s_suppkey as repartidor_id, s_name as nombre,
         case when s_acctbal > 7500 then 'ACTIVO' else 'INACTIVO' end as estado
  from supplier where s_acctbal > 5000"""
ASIGNACIONES = """
  select l_orderkey as pedido_id, min(l_suppkey) as repartidor_id
  from lineitem where l_returnflag = 'R' group by l_orderkey"""
TODAS = """
  select distinct l_orderkey as pedido_id, l_suppkey as repartidor_id
  from lineitem where l_returnflag = 'R'"""

DIMS = {
    "dim_clientes": f"select distinct * from ({USUARIOS})",
    "dim_wallets": """
      select distinct c_custkey as cliente_id, c_acctbal as saldo, c_name, c_nationkey, c_mktsegment from customer""",
    "dim_productos": """
      select distinct p_partkey as producto_id, p_brand as catalogo_id, p_name as nombre,
             p_type as categoria, p_retailprice as precio from part""",
    "dim_repartidores": f"select distinct * from ({REPARTIDORES})",
    "dim_ubicaciones": """
      select distinct user_id as "repartidorId", value as latitud, cast(event_id as double) as longitud,
             ts as "timestamp" from events""",
    "dim_sesiones": """
      select distinct user_id as "repartidorId", ts as fecha_inicio,
             ts + interval '30' minute as fecha_expiracion, value > 50 as activa
      from events where event_type = 'signup'""",
    "dim_transacciones": """
      select distinct event_id as id, user_id as origin_user_id, (user_id * 7) % 100 as destination_user_id,
             ts as transaction_date, case when event_id % 2 = 0 then 'BTC' else 'ARS' end as currency_type,
             value as amount, event_type as concept
      from events where event_type = 'purchase'""",
    "dim_wallets_blockchain": "select distinct s_suppkey as id, s_name, s_nationkey, s_acctbal from supplier",
    "dim_tenants": "select distinct r_regionkey as tenant_id, r_name from region",
    "dim_catalogos": "select distinct n_nationkey as catalogo_id, n_name, n_regionkey from nation",
    "dim_promociones": """
      select distinct p_partkey as promocion_id, p_name, p_brand, p_type, p_size, p_retailprice from part""",
    "dim_imagenes_producto": "select distinct page_id as imagen_id, url, html from pages",
    "dim_datos_contacto": "select distinct s_suppkey as contacto_id, s_name, s_nationkey, s_acctbal from supplier",
    "dim_fecha": """
      select fecha, cast(year(fecha) as int) as anio, cast(month(fecha) as int) as mes,
             cast(day(fecha) as int) as dia, cast(quarter(fecha) as int) as trimestre,
             monthname(fecha) as nombre_mes, dayname(fecha) as nombre_dia,
             cast(dayofweek(fecha) + 1 as int) as numero_dia_semana
      from (select distinct cast(o_orderdate as date) as fecha from orders)""",
    "dim_ratings": """
      select distinct event_id as rating_id, event_id % 15000 as pedido_id, user_id % 100 as repartidor_id,
             cast(event_id % 5 + 1 as int) as puntaje, props as comentario, ts as fecha_creacion
      from events where event_type = 'view'""",
    "dim_pedidos_delivery": """
      select distinct o_orderkey as pedido_id, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
             o_orderpriority from orders""",
}

STORED = {
    "dim_clientes": "apellido <> 'BUILDING'",
    "dim_wallets": "saldo > 0",
    "dim_productos": "precio > 1000",
    "dim_repartidores": "estado = 'ACTIVO'",
    "dim_ubicaciones": "latitud > 50",
    "dim_sesiones": "activa",
    "dim_transacciones": "currency_type = 'BTC'",
    "dim_wallets_blockchain": "s_acctbal > 0",
    "dim_tenants": "r_name > 'AMERICA'",
    "dim_catalogos": "n_regionkey > 1",
    "dim_promociones": "p_size > 10",
    "dim_imagenes_producto": "url like '%1%'",
    "dim_datos_contacto": "s_acctbal > 0",
    "dim_fecha": "anio < 2000",
    "dim_ratings": "puntaje > 2",
    "dim_pedidos_delivery": "o_orderstatus = 'F'",
}
# Keys of the incremental load that are not the first column alone.
KEYS = {"dim_ubicaciones": '"repartidorId", "timestamp"', "dim_sesiones": '"repartidorId", fecha_inicio'}


def fact(assignments: str = ASIGNACIONES) -> str:
    return f"""
      select l_orderkey as pedido_id, cast(o_orderdate as date) as fecha_pedido, c_custkey as cliente_id,
             l_partkey as producto_id, p_brand as catalogo_id, a.repartidor_id,
             case when o_orderpriority = '1-URGENT' then 'CRIPTO' else o_orderpriority end as "metodoPago",
             o_orderstatus as estado, coalesce(o_orderpriority = '1-URGENT', false) as es_cripto,
             l_extendedprice as total_producto, o_custkey % 5 as tenant_id, o_totalprice as calificacion,
             o_orderpriority as comentario, cast(o_orderkey % 60 as int) as tiempo_entrega_min
      from lineitem
      join orders on l_orderkey = o_orderkey
      join part on l_partkey = p_partkey
      join customer on o_custkey = c_custkey
      left join ({assignments}) a on a.pedido_id = l_orderkey
      left join ({REPARTIDORES}) r on r.repartidor_id = a.repartidor_id"""


MARK = "select max(cast(o_orderdate as date)) from orders where o_orderdate < '2000-01-01'"
LATE_MARK = """
  select max(cast(o_orderdate as date)) from orders
  where o_orderdate < '2000-01-01' and o_orderpriority <> '1-URGENT'
    and exists (select 1 from lineitem where l_orderkey = o_orderkey)"""


FIRST_COLUMN = {
    "dim_clientes": "cliente_id",
    "dim_wallets": "cliente_id",
    "dim_productos": "producto_id",
    "dim_repartidores": "repartidor_id",
    "dim_ubicaciones": '"repartidorId"',
    "dim_sesiones": '"repartidorId"',
    "dim_transacciones": "id",
    "dim_wallets_blockchain": "id",
    "dim_tenants": "tenant_id",
    "dim_catalogos": "catalogo_id",
    "dim_promociones": "promocion_id",
    "dim_imagenes_producto": "imagen_id",
    "dim_datos_contacto": "contacto_id",
    "dim_fecha": "fecha",
    "dim_ratings": "rating_id",
    "dim_pedidos_delivery": "pedido_id",
}


def incremental_dims() -> str:
    counts = []
    for name, sql in DIMS.items():
        key = KEYS.get(name, FIRST_COLUMN[name])
        counts.append(
            f"select '{name}' as tabla, count(*) as nuevas from ({sql}) d "
            f"where ({key}) not in (select ({key}) from ({sql}) s where {STORED[name]})"
        )
    return " union all ".join(counts)


def repeated_keys() -> str:
    return " union all ".join(
        f"select '{name}' as tabla, count(*) as repetidas from "
        f"(select 1 from ({sql}) d group by {FIRST_COLUMN[name]} having count(*) > 1)"
        for name, sql in DIMS.items()
    )


def load_counts(tables: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{name}' as tabla, count(*) as filas from ({sql}) t" for name, sql in tables.items()
    )


ALL_TABLES = {**DIMS, "fact_pedidos": fact(), "fact_ratings": DIMS["dim_ratings"]}
ADDED = {
    **{name: f"select * from ({sql}) e where false" for name, sql in ALL_TABLES.items()},
    "dim_fecha": f"select * from ({DIMS['dim_fecha']}) f where fecha >= date '2000-01-01'",
    "dim_pedidos_delivery": "select * from orders where o_orderdate >= '2000-01-01'",
    "fact_pedidos": f"""
      select * from ({fact()}) f where fecha_pedido > (
        {MARK} and exists (select 1 from lineitem where l_orderkey = o_orderkey))""",
}

# Every table, of the loads up to a year; the next load adds what the one before does not have.
def keyed_loads() -> str:
    def up_to(name: str, year: int) -> str:
        if name == "dim_fecha":
            return f"select * from ({DIMS[name]}) where anio < {year}"
        if name == "dim_pedidos_delivery":
            return f"select * from ({DIMS[name]}) where year(o_orderdate) < {year}"
        if name == "fact_pedidos":
            return f"select * from ({fact()}) where year(fecha_pedido) < {year}"
        return ALL_TABLES[name]

    lines = []
    for load, year, before in (("a", 2000, None), ("b", 2001, 2000), ("c", 9999, 2001)):
        for name in ALL_TABLES:
            had = f"(select count(*) from ({up_to(name, before)}) h)" if before else "0"
            lines.append(f"select '{name}' as tabla, (select count(*) from ({up_to(name, year)}) n) - {had} as filas, '{load}' as carga")
    return " union all ".join(lines)


WIDENED = f"""
  select 'dim_productos' as tabla, cast(p_partkey as varchar) as clave, p_name as valor from part
  union all select 'dim_productos', 'p-' || p_partkey, p_name from part where p_partkey % 2 = 1
  union all select 'dim_transacciones', cast(id as varchar), cast(cast(cast(amount as varchar) as decimal(38, 18)) as varchar) from ({DIMS['dim_transacciones']}) t
  union all select 'dim_transacciones', 't-' || id, id || '.000000000000000001' from ({DIMS['dim_transacciones']}) t where id % 2 = 1
  union all select 'fact_pedidos',
      case when year(fecha_pedido) >= 2000 and producto_id % 2 = 1 then 'p-' else '' end || producto_id, cast(fecha_pedido as varchar) from ({fact()}) f
  union all select 'fact_ratings', cast(cast(rating_id as double) as varchar), cast(cast(puntaje as double) as varchar) from ({DIMS['dim_ratings']}) r
  union all select 'fact_ratings', cast(rating_id + cast(0.5 as double) as varchar), cast(puntaje + cast(0.5 as double) as varchar) from ({DIMS['dim_ratings']}) r"""

LOCATION_MESSAGES = """
  select cast(user_id as varchar) as repartidor_id, value as latitud, cast(event_id as double) as longitud,
         ts as "timestamp" from events"""

ORACLE: dict[str, str] = {
    "fact_pedidos": fact(),
    "fact_pedidos_first_load": fact(),
    "fact_pedidos_incremental": f"select * from ({fact()}) f where fecha_pedido > ({MARK})",
    "fact_pedidos_lookback": f"""
      with f as ({fact()}), m as (select ({LATE_MARK}) - 60 as since)
      select f.* from f, m where fecha_pedido > since and not exists (
        select 1 from f g where g.fecha_pedido > since and g.fecha_pedido < date '2000-01-01'
          and g."metodoPago" <> 'CRIPTO' and g.pedido_id = f.pedido_id and g.producto_id = f.producto_id)""",
    "fact_pedidos_split": fact(),
    "fact_incremental_shuffle": f"select * from ({fact()}) f where fecha_pedido > ({MARK})",
    "fact_ratings": DIMS["dim_ratings"],
    **DIMS,
    "join_inner_using": """
      select l_orderkey as pedido_id, l_partkey as producto_id, l_extendedprice as precio_unitario,
             o_custkey as cliente_id_pedido, o_orderstatus as estado_pedido
      from lineitem join orders on l_orderkey = o_orderkey""",
    "join_inner_on": """
      select o_orderkey as pedido_id, c_custkey as cliente_id, c_name as nombre
      from orders join customer on o_custkey = c_custkey""",
    "join_left_using": f"""
      select o_orderkey as pedido_id, o_orderstatus as estado_pedido, a.repartidor_id as "repartidorId"
      from orders left join ({ASIGNACIONES}) a on a.pedido_id = o_orderkey""",
    "join_left_fanout": fact(TODAS),
    "join_left_on": """
      select s.s_suppkey as "repartidorId", d.s_suppkey as repartidor_id, d.s_name as nombre
      from supplier s left join (select * from supplier where s_acctbal > 5000) d on s.s_suppkey = d.s_suppkey""",
    "dim_distinct_rows": "select distinct p_brand, p_type from part",
    "distinct_keys": "select distinct user_id from events",
    "distinct_dates": "select distinct cast(o_orderdate as date) as fecha from orders",
    "high_water_mark": f"select ({MARK}) as marca",
    "is_empty": "select count(*) = 0 as vacia from orders where o_orderstatus = 'Z'",
    "anti_new_customers": f"""
      select * from ({DIMS['dim_clientes']}) d where cliente_id not in (
        select c_custkey from customer where c_mktsegment <> 'BUILDING')""",
    "anti_probe_shuffle": f"""
      select * from ({DIMS['dim_clientes']}) d where cliente_id not in (
        select c_custkey from customer where c_mktsegment <> 'BUILDING')""",
    "anti_nonunique_key": f"""
      select * from ({DIMS['dim_ubicaciones']}) d where "repartidorId" not in (
        select user_id from events where event_type = 'signup' and ts < '2024-01-03')""",
    "incremental_dims": incremental_dims(),
    "repeated_keys": repeated_keys(),
    "src_csv_roundtrip": "select * from documents",
    "src_csv_catalog": fact(),
    "src_csv_misfits": """
      select 'ratings' as tabla, 'r-' || event_id as id, (event_id % 5) + cast(0.5 as double) as numero from events
      union all
      select 'transacciones', 't-' || event_id, cast(event_id || '.00012345' as double) from events""",
    "sink_roundtrip": fact(),
    "full_load_counts": load_counts(ALL_TABLES),
    "next_load_counts": load_counts(ADDED),
    "next_load_widened": WIDENED,
    "next_load_keyed": keyed_loads(),
    "loaded_fact_pedidos": fact(),
    **{f"loaded_{name}": DIMS[name] for name in ("dim_fecha", "dim_pedidos_delivery", "dim_imagenes_producto")},
    "json_parse": "select event_id, cast(props ->> 'k' as int) as k from events",
    "json_malformed": """
      select event_id,
             case when event_id % 4 <> 0 then cast(user_id as varchar) end as repartidor_id,
             case when event_id % 4 in (1, 3) then cast(1.5 as double) end as latitud,
             case when event_id % 4 <> 0 then cast(2.5 as double) end as longitud
      from events""",
    "stream_locations": LOCATION_MESSAGES,
    "stream_replay": LOCATION_MESSAGES,
    "stream_merged_log": LOCATION_MESSAGES,
    "stream_restart": f"{LOCATION_MESSAGES} union all {LOCATION_MESSAGES}",
    "stream_status": """
      select cast(event_id as varchar) as pedido_id, event_type as estado, ts as "timestamp" from events""",
    "stream_two_feeds": """
      select cast(user_id as varchar) as repartidor_id, value as latitud, cast(event_id as double) as longitud,
             ts as "timestamp", 'ubicaciones_realtime' as tabla, null::varchar as pedido_id, null::varchar as estado
      from events
      union all
      select null, null, null, ts, 'estado_pedidos_realtime', cast(event_id as varchar), event_type from events""",
    "latest_by_key": """
      select * from events
      qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
    "stream_upsert": f"""
      {LOCATION_MESSAGES} qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
}
