"""The library's operators run on the benchmark tables: one callable per query.

Every query takes whole tables. What was "stored earlier" in the incremental
queries is given by a condition on the data, e.g. the orders dated before 2000.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from starfeed.functions import message_fields, to_day
from starfeed.operators import (
    FACT_INPUTS,
    build_dimension,
    distinct_keys,
    fact_orders,
    fact_profile,
    fact_ratings,
    high_water_mark,
    hot_keys,
    latest_by_key,
    new_dimension_rows,
    new_rows,
    repeated_keys,
    skew_join,
)
from starfeed.operators.dims import DIMENSIONS
from starfeed.operators.incremental import BROADCAST_KEYS, PROBE_ROWS
from starfeed.plans import LOAD_PLAN, LoadStep, run_daily
from starfeed.plans.daily import facts_after, new_order_facts
from starfeed.sinks import ParquetWarehouse
from starfeed.sources import SOURCES, land, load_sources, read_csv, source_path
from starfeed.sources import testdata
from starfeed.streaming import LOCATIONS, STATUSES, LatestState, ParquetLog, parse_messages, run_feeds, start_feed
from starfeed.workspace import work_dir, written

Query = Callable[[SparkSession, str], DataFrame]

MESSAGE_TIME = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

# What the warehouse already holds, per dimension, in the incremental query.
STORED_BEFORE = {
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


def fact_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return testdata.load(spark, sf_dir, FACT_INPUTS)


def whole_fact(inputs: Mapping[str, DataFrame]) -> DataFrame:
    """The order fact of inputs that are files already, but for the assignments derived here."""
    filed = {**inputs, "asignaciones": written(inputs["asignaciones"], "assignments")}
    return fact_orders(filed, fact_profile(filed))


def balanced_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """A join on ``key`` that splits the keys heavy on either side, which are tables from files."""
    with ThreadPoolExecutor(2) as pool:
        left_hot, right_hot = pool.map(lambda df: hot_keys(df, [key])[key], (left, right))
    return skew_join(left, right, key, how, left_hot, right_hot)


def daily_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All inputs as files, as after landing the extracts."""
    inputs = testdata.load(spark, sf_dir)
    return {**inputs, "asignaciones": written(inputs["asignaciones"], "assignments")}


# ---- star schema ----------------------------------------------------------------------


def dimension(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build_dimension(name, testdata.load(spark, sf_dir, [DIMENSIONS[name].source]))

    return run


def fact_pedidos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whole_fact(fact_inputs(spark, sf_dir))


def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = testdata.load(spark, sf_dir, ["pedidos"])["pedidos"]
    return orders.where("fechaCreacion < '2000-01-01'").select(to_day(orders, "fechaCreacion").alias("fecha_pedido"))


def fact_pedidos_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = ParquetWarehouse(spark, work_dir(spark, "warehouse"))
    inputs = fact_inputs(spark, sf_dir)
    inputs["asignaciones"] = written(inputs["asignaciones"], "assignments")
    return new_order_facts(inputs, warehouse, warehouse.mark("fact_pedidos", "fecha_pedido"))


def fact_pedidos_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = high_water_mark(stored_orders(spark, sf_dir), "fecha_pedido")
    return facts_after(fact_inputs(spark, sf_dir), mark, BROADCAST_KEYS)


def fact_pedidos_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urgent orders arrive late: the stored load has none of them, up to the end of 1999."""
    inputs = fact_inputs(spark, sf_dir)
    inputs["asignaciones"] = written(inputs["asignaciones"], "assignments")
    orders = inputs["pedidos"].where("fechaCreacion < '2000-01-01' and metodoPago <> 'CRIPTO'")
    warehouse = ParquetWarehouse(spark, work_dir(spark, "warehouse"))
    stored = {**inputs, "pedidos": orders}
    rows = warehouse.append("fact_pedidos", fact_orders(stored, fact_profile(stored)), "first")
    warehouse.finish("first", {"fact_pedidos": rows})
    mark = warehouse.mark("fact_pedidos", "fecha_pedido")
    return new_order_facts(inputs, warehouse, mark, lookback_days=60)


def fact_pedidos_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order fact with every key above the share split and no dimension broadcast."""
    inputs = daily_inputs(spark, sf_dir)
    return fact_orders(inputs, fact_profile(inputs, probe=0, share=0.0005, min_rows=0))


def fact_incremental_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The increment when more orders are new than may be broadcast."""
    mark = high_water_mark(stored_orders(spark, sf_dir), "fecha_pedido")
    return facts_after(fact_inputs(spark, sf_dir), mark, 0, dimension_probe=0, share=0.0005, min_rows=0)


def fact_ratings_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_ratings(testdata.load(spark, sf_dir, ["ratings"]))


# ---- single operators -----------------------------------------------------------------


def join_inner_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = testdata.load(spark, sf_dir, ["pedido_productos", "pedidos"])
    orders = inputs["pedidos"].select("pedido_id", "cliente_id_pedido", "estado_pedido")
    return balanced_join(inputs["pedido_productos"], orders, "pedido_id")


def join_inner_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = testdata.load(spark, sf_dir, ["pedidos", "usuarios"])
    orders = inputs["pedidos"].select("pedido_id", F.col("cliente_id_pedido").alias("cliente_id"))
    customers = written(inputs["usuarios"].select("cliente_id", "nombre"), "customers")
    return balanced_join(orders, customers, "cliente_id")


def join_left_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = testdata.load(spark, sf_dir, ["pedidos", "asignaciones"])
    orders = inputs["pedidos"].select("pedido_id", "estado_pedido")
    return balanced_join(orders, written(inputs["asignaciones"], "assignments"), "pedido_id", "left")


def join_left_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whole_fact({**fact_inputs(spark, sf_dir), "asignaciones": testdata.all_assignments(spark, sf_dir)})


def join_left_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = testdata.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("repartidorId"))
    drivers = testdata.load(spark, sf_dir, ["repartidores"])["repartidores"]
    drivers = drivers.select(F.col("repartidor_id").alias("repartidorId"), "repartidor_id", "nombre")
    return balanced_join(suppliers, drivers, "repartidorId", "left")


def dim_distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.table(spark, sf_dir, "part").select("p_brand", "p_type").dropDuplicates()


def distinct_keys_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_keys(testdata.table(spark, sf_dir, "events"), "user_id")


def distinct_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = testdata.load(spark, sf_dir, ["pedidos"])["pedidos"]
    return orders.select(to_day(orders, "fechaCreacion").alias("fecha")).distinct()


def high_water_mark_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = high_water_mark(stored_orders(spark, sf_dir), "fecha_pedido")
    return spark.createDataFrame([(mark,)], "marca date")


def is_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = testdata.table(spark, sf_dir, "orders").where("o_orderstatus = 'Z'")
    return spark.range(1).select((~none.exists()).alias("vacia"))


def anti_new_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension_news("dim_clientes", ["cliente_id"], testdata.load(spark, sf_dir, ["usuarios"]))


def anti_probe_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, keys first and then the rows by shuffle, as for a large table with many new keys."""
    inputs = testdata.load(spark, sf_dir, ["usuarios"])
    return dimension_news("dim_clientes", ["cliente_id"], inputs, probe=0, probe_rows=0)


def dimension_news(
    name: str, keys: Sequence[str], inputs: Mapping[str, DataFrame], probe: int = BROADCAST_KEYS, probe_rows: int = PROBE_ROWS
) -> DataFrame:
    stored = build_dimension(name, inputs).where(STORED_BEFORE[name])
    return new_dimension_rows(name, inputs, stored, keys, probe=probe, probe_rows=probe_rows)


def anti_nonunique_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations keyed by driver alone: a driver seen once never gains new locations."""
    locations = testdata.load(spark, sf_dir, ["ubicaciones"])["ubicaciones"]
    sessions = testdata.load(spark, sf_dir, ["sesiones"])["sesiones"].where("fecha_inicio < '2024-01-03'")
    hot = hot_keys(locations, ["repartidorId"])["repartidorId"]
    return new_rows(locations, sessions, "repartidorId", null_safe=False, hot=hot).dropDuplicates()


def incremental_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per dimension, the number of rows a load would add to those stored before."""
    inputs = testdata.load(spark, sf_dir)

    def count(step: LoadStep) -> DataFrame:
        new = dimension_news(step.table, step.keys, inputs)
        return new.agg(F.count(F.lit(1)).alias("nuevas")).select(F.lit(step.table).alias("tabla"), "nuevas")

    with ThreadPoolExecutor(8) as pool:
        return reduce(DataFrame.unionAll, pool.map(count, LOAD_PLAN))


def repeated_keys_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per dimension, the keys of more than one row, by the keys of the literal load."""
    inputs = testdata.load(spark, sf_dir)

    def count(step: LoadStep) -> DataFrame:
        repeated = repeated_keys(build_dimension(step.table, inputs), step.literal_keys or step.keys)
        return repeated.select(F.lit(step.table).alias("tabla"), "repetidas")

    return reduce(DataFrame.unionAll, map(count, LOAD_PLAN))


# ---- sources and sinks ------------------------------------------------------------------


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of files of bounded size, as one with line breaks in its fields cannot be split."""
    (
        df.write.option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", 200_000)
        .csv(path)
    )


def src_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = testdata.table(spark, sf_dir, "documents")
    path = work_dir(spark, "documents-csv")
    write_csv(documents, path)
    return read_csv(spark, path, {f.name: f.dataType for f in documents.schema})


def src_csv_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order fact from CSV extracts under their own names, raw columns renamed on reading."""
    base, given = work_dir(spark, "extracts"), fact_inputs(spark, sf_dir)
    for name, df in given.items():
        raw = {new: old for old, new in SOURCES[name].renames.items()}
        write_csv(df.withColumnsRenamed(raw), source_path(base, name))
    read = load_sources(spark, base, FACT_INPUTS)  # catalogues are brand names here: that column becomes text
    landed = land(read, work_dir(spark, "landed"))
    return fact_orders(landed, fact_profile(landed))


def src_csv_misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text ids, half ratings and fractions of a cent, none of which the catalogue's types hold."""
    base, events = work_dir(spark, "extracts"), testdata.table(spark, sf_dir, "events")
    ratings = events.select(
        F.format_string("r-%d", "event_id").alias("id"), F.format_string("%d.5", F.col("event_id") % 5).alias("puntaje")
    )
    transactions = events.select(
        F.format_string("t-%d", "event_id").alias("id"), F.format_string("%d.00012345", "event_id").alias("amount")
    )
    write_csv(ratings, source_path(base, "ratings"))
    write_csv(transactions, source_path(base, "transacciones"))
    read = load_sources(spark, base, ["ratings", "transacciones"])
    parts = [
        read[name].select(F.lit(name).alias("tabla"), "id", F.col(column).alias("numero"))
        for name, column in (("ratings", "puntaje"), ("transacciones", "amount"))
    ]
    return parts[0].unionAll(parts[1])


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = ParquetWarehouse(spark, work_dir(spark, "warehouse"))
    rows = warehouse.append("fact_pedidos", fact_pedidos(spark, sf_dir), "first")
    warehouse.finish("first", {"fact_pedidos": rows})
    return warehouse.stored("fact_pedidos")


def loaded_rows(name: str) -> Query:
    """The rows of a table after the two loads that ``next_load_counts`` counts."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return two_loads(spark, sf_dir)[0].stored(name)

    return run


def counts_table(spark: SparkSession, added: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(added.items()), "tabla string, filas long")


def full_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = ParquetWarehouse(spark, work_dir(spark, "warehouse"))
    return counts_table(spark, run_daily(daily_inputs(spark, sf_dir), warehouse, "first"))


def two_loads(spark: SparkSession, sf_dir: str) -> tuple[ParquetWarehouse, dict[str, int]]:
    """A load made when the year 2000 had not begun, and another on all inputs; what the second one adds."""
    inputs = daily_inputs(spark, sf_dir)
    before = {
        **inputs,
        "pedidos": inputs["pedidos"].where("fechaCreacion < '2000-01-01'"),
        "delivery_pedidos": inputs["delivery_pedidos"].where("o_orderdate < '2000-01-01'"),
    }
    warehouse = ParquetWarehouse(spark, work_dir(spark, "warehouse"))
    run_daily(before, warehouse, "first")
    return warehouse, run_daily(inputs, warehouse, "second")


def next_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_table(spark, two_loads(spark, sf_dir)[1])


def widened_loads(spark: SparkSession, sf_dir: str) -> ParquetWarehouse:
    """A load made when the year 2000 had not begun, and one on all inputs after the extracts' types have changed: product and transaction ids
    are text and some of another form, amounts are finer than a double, ratings and their ids have halves."""
    inputs = daily_inputs(spark, sf_dir)
    warehouse = ParquetWarehouse(spark, work_dir(spark, "warehouse"))
    run_daily({**inputs, "pedidos": inputs["pedidos"].where("fechaCreacion < '2000-01-01'")}, warehouse, "first")
    text_id = "if({0} % 2 = 1, concat('p-', {0}), cast({0} as string))".format
    products = inputs["productos"]
    odd = {"producto_id": F.expr(text_id("producto_id"))}
    changed = {
        **inputs,
        "productos": products.withColumn("producto_id", F.col("producto_id").cast("string")).unionByName(products.where("producto_id % 2 = 1").withColumns(odd)),
        "pedido_productos": inputs["pedido_productos"].withColumns(odd),
        "transacciones": inputs["transacciones"].withColumns(
            {"id": F.expr("if(id % 2 = 1, concat('t-', id), cast(id as string))"), "amount": F.expr("cast(concat(id, '.000000000000000001') as decimal(38, 18))")}
        ),
        "ratings": inputs["ratings"].withColumns({"id": F.expr("id + 0.5D"), "puntaje": F.expr("puntaje + 0.5D")}),
    }
    run_daily(changed, warehouse, "second")
    return warehouse


def next_load_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of both loads, read back from four tables whose types changed between them."""
    warehouse = widened_loads(spark, sf_dir)
    shown = {
        "dim_productos": ("producto_id", "nombre"),
        "dim_transacciones": ("id", "amount"),
        "fact_pedidos": ("producto_id", "fecha_pedido"),
        "fact_ratings": ("rating_id", "puntaje"),
    }
    parts = [
        warehouse.stored(name, list(columns)).select(F.lit(name).alias("tabla"), *[F.col(c).cast("string").alias(a) for c, a in zip(columns, ("clave", "valor"))])
        for name, columns in shown.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def next_load_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three loads add when every table has a key store: one before the year 2000, which has none yet, one up to its end, and one on all inputs."""
    inputs = daily_inputs(spark, sf_dir)
    warehouse = ParquetWarehouse(spark, work_dir(spark, "warehouse"), key_rows=0)

    def until(year: int) -> dict[str, DataFrame]:
        return {
            **inputs,
            "pedidos": inputs["pedidos"].where(F.year("fechaCreacion") < year),
            "delivery_pedidos": inputs["delivery_pedidos"].where(F.year("o_orderdate") < year),
        }

    added = [
        counts_table(spark, run_daily(given, warehouse, load_id, probe_rows=probe_rows)).withColumn("carga", F.lit(load_id))
        for load_id, given, probe_rows in (("a", until(2000), 0), ("b", until(2001), 0), ("c", inputs, PROBE_ROWS))
    ]
    return reduce(DataFrame.unionAll, added)


# ---- messages and streams -------------------------------------------------------------------


def json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = testdata.table(spark, sf_dir, "events")
    schema = spark.createDataFrame([], "k int").schema
    return events.select("event_id", message_fields("props", schema)["k"].alias("k"))


def json_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Junk, good, bad number, and a number for a text with an unknown field, in turn."""
    events = testdata.table(spark, sf_dir, "events")
    kind = F.col("event_id") % 4
    text = (
        F.when(kind == 0, F.concat(F.lit("no es json "), F.col("event_type")))
        .when(kind == 1, F.format_string('{"repartidor_id":"%d","latitud":1.5,"longitud":2.5}', "user_id"))
        .when(kind == 2, F.format_string('{"repartidor_id":"%d","latitud":"x","longitud":2.5}', "user_id"))
        .otherwise(F.format_string('{"repartidor_id":%d,"latitud":1.5,"longitud":2.5,"otro":1}', "user_id"))
    )
    messages = events.select("event_id", text.cast("binary").alias("value"))
    fields = messages.select("event_id", message_fields("value", LOCATIONS.schema).alias("data"))
    return fields.select("event_id", "data.repartidor_id", "data.latitud", "data.longitud")


def location_messages(events: DataFrame) -> DataFrame:
    """Events in the shape of a broker's messages: a key and a JSON body in bytes."""
    body = F.struct(
        F.col("user_id").cast("string").alias("repartidor_id"),
        F.col("value").alias("latitud"),
        F.col("event_id").cast("double").alias("longitud"),
        F.col("ts").alias("timestamp"),
    )
    return _messages(events, body)


def status_messages(events: DataFrame) -> DataFrame:
    body = F.struct(
        F.col("event_id").cast("string").alias("pedido_id"),
        F.col("event_type").alias("estado"),
        F.col("ts").alias("timestamp"),
    )
    return _messages(events, body)


def _messages(events: DataFrame, body) -> DataFrame:
    return events.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.to_json(body, MESSAGE_TIME).cast("binary").alias("value"),
    )


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a glob, so that the table may be one file or a folder of files
    schema = testdata.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/event[s].parquet")


def plain_time(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def stream_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = ParquetLog(work_dir(spark, "locations"))
    rows = parse_messages(location_messages(event_stream(spark, sf_dir)), LOCATIONS)
    start_feed(rows, log.write, work_dir(spark, "checkpoint"), available_now=True).awaitTermination()
    return plain_time(log.read(spark).drop("ingestion_time"))


def stream_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = ParquetLog(work_dir(spark, "statuses"))
    rows = parse_messages(status_messages(event_stream(spark, sf_dir)), STATUSES)
    start_feed(rows, log.write, work_dir(spark, "checkpoint"), available_now=True).awaitTermination()
    return plain_time(log.read(spark).drop("ingestion_time"))


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query fails when its batch is stored but not yet committed, and restarts from its checkpoint."""
    log, checkpoint = ParquetLog(work_dir(spark, "replayed")), work_dir(spark, "checkpoint")
    rows = parse_messages(location_messages(event_stream(spark, sf_dir)), LOCATIONS)

    def write_and_fail(batch: DataFrame, batch_id: int) -> None:
        log.write(batch, batch_id)
        raise RuntimeError("lost before the commit")

    try:
        start_feed(rows, write_and_fail, checkpoint, available_now=True).awaitTermination()
    except StreamingQueryException as lost:
        if "lost before the commit" not in str(lost):
            raise
    start_feed(rows, log.write, checkpoint, available_now=True).awaitTermination()
    return plain_time(log.read(spark).drop("ingestion_time"))


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second query, with a checkpoint of its own, reads all messages into the log of the first: both keep their rows."""
    log = ParquetLog(work_dir(spark, "restarted"))
    rows = parse_messages(location_messages(event_stream(spark, sf_dir)), LOCATIONS)
    for _ in range(2):
        start_feed(rows, log.write, work_dir(spark, "checkpoint"), available_now=True).awaitTermination()
    return plain_time(log.read(spark).drop("ingestion_time"))


def stream_merged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in many micro-batches, whose files are merged by the way, beside the query."""
    log = ParquetLog(work_dir(spark, "merged"), fan=2)
    files = max(6, int(spark.conf.get("spark.sql.shuffle.partitions")))
    topic = work_dir(spark, "topic")
    location_messages(testdata.table(spark, sf_dir, "events")).repartition(files, "key").write.parquet(topic)
    messages = spark.readStream.schema("key binary, value binary").option("maxFilesPerTrigger", -(-files // 6)).parquet(topic)

    def write_and_merge(batch: DataFrame, batch_id: int) -> None:
        log.write(batch, batch_id)
        if batch_id % 2:
            log.merge(spark)

    start_feed(parse_messages(messages, LOCATIONS), write_and_merge, work_dir(spark, "checkpoint"), available_now=True).awaitTermination()
    return plain_time(log.read(spark).drop("ingestion_time"))


def stream_two_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = {feed.topic: ParquetLog(work_dir(spark, feed.table)) for feed in (LOCATIONS, STATUSES)}
    events = event_stream(spark, sf_dir)
    run_feeds(
        {LOCATIONS.topic: location_messages(events), STATUSES.topic: status_messages(events)},
        {topic: log.write for topic, log in logs.items()},
        work_dir(spark, "checkpoint"),
        available_now=True,
    )
    locations, statuses = (
        logs[feed.topic].read(spark).drop("ingestion_time").withColumn("tabla", F.lit(feed.table))
        for feed in (LOCATIONS, STATUSES)
    )
    return plain_time(locations.unionByName(statuses, allowMissingColumns=True))


def latest_by_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = testdata.table(spark, sf_dir, "events")
    return latest_by_key(events, "user_id", ["ts", "event_id"])


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in several micro-batches, kept as the last location of each driver."""
    files = max(3, int(spark.conf.get("spark.sql.shuffle.partitions")))
    topic = work_dir(spark, "topic")
    location_messages(testdata.table(spark, sf_dir, "events")).repartition(files, "key").write.parquet(topic)
    messages = (
        spark.readStream.schema("key binary, value binary")
        .option("maxFilesPerTrigger", -(-files // 3))
        .parquet(topic)
    )
    state = LatestState(work_dir(spark, "state"), LOCATIONS.key, ["timestamp", "longitud"], fold_every=2)
    rows = parse_messages(messages, LOCATIONS)
    start_feed(rows, state.write, work_dir(spark, "checkpoint"), available_now=True).awaitTermination()
    return plain_time(state.read(spark).drop("ingestion_time"))


QUERIES: dict[str, Query] = {
    "fact_pedidos": fact_pedidos,
    "fact_pedidos_first_load": fact_pedidos_first_load,
    "fact_pedidos_incremental": fact_pedidos_incremental,
    "fact_pedidos_lookback": fact_pedidos_lookback,
    "fact_pedidos_split": fact_pedidos_split,
    "fact_incremental_shuffle": fact_incremental_shuffle,
    "fact_ratings": fact_ratings_query,
    **{name: dimension(name) for name in DIMENSIONS},
    "join_inner_using": join_inner_using,
    "join_inner_on": join_inner_on,
    "join_left_using": join_left_using,
    "join_left_fanout": join_left_fanout,
    "join_left_on": join_left_on,
    "dim_distinct_rows": dim_distinct_rows,
    "distinct_keys": distinct_keys_query,
    "distinct_dates": distinct_dates,
    "high_water_mark": high_water_mark_query,
    "is_empty": is_empty,
    "anti_new_customers": anti_new_customers,
    "anti_probe_shuffle": anti_probe_shuffle,
    "anti_nonunique_key": anti_nonunique_key,
    "incremental_dims": incremental_dims,
    "repeated_keys": repeated_keys_query,
    "src_csv_roundtrip": src_csv_roundtrip,
    "src_csv_catalog": src_csv_catalog,
    "src_csv_misfits": src_csv_misfits,
    "sink_roundtrip": sink_roundtrip,
    "full_load_counts": full_load_counts,
    "next_load_counts": next_load_counts,
    "next_load_widened": next_load_widened,
    "next_load_keyed": next_load_keyed,
    "loaded_fact_pedidos": loaded_rows("fact_pedidos"),
    "loaded_dim_fecha": loaded_rows("dim_fecha"),
    "loaded_dim_pedidos_delivery": loaded_rows("dim_pedidos_delivery"),
    "loaded_dim_imagenes_producto": loaded_rows("dim_imagenes_producto"),
    "json_parse": json_parse,
    "json_malformed": json_malformed,
    "stream_locations": stream_locations,
    "stream_status": stream_status,
    "stream_replay": stream_replay,
    "stream_restart": stream_restart,
    "stream_merged_log": stream_merged_log,
    "stream_two_feeds": stream_two_feeds,
    "latest_by_key": latest_by_key_query,
    "stream_upsert": stream_upsert,
}
