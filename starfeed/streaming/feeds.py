"""The two real-time feeds: driver locations and order status."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from starfeed.functions import message_fields


@dataclass(frozen=True)
class Feed:
    """``topic``: where messages come from; ``table``: where they go; ``key``: what one is about."""

    topic: str
    table: str
    key: str
    schema: T.StructType


# Topics, tables and message fields.
LOCATIONS = Feed(
    "ubicaciones_repartidores",
    "ubicaciones_realtime",
    "repartidor_id",
    T.StructType(
        [
            T.StructField("repartidor_id", T.StringType()),
            T.StructField("latitud", T.DoubleType()),
            T.StructField("longitud", T.DoubleType()),
            T.StructField("timestamp", T.TimestampType()),
        ]
    ),
)
STATUSES = Feed(
    "estados_pedidos",
    "estado_pedidos_realtime",
    "pedido_id",
    T.StructType(
        [
            T.StructField("pedido_id", T.StringType()),
            T.StructField("estado", T.StringType()),
            T.StructField("timestamp", T.TimestampType()),
        ]
    ),
)


def parse_messages(messages: DataFrame, feed: Feed) -> DataFrame:
    """One row per message: its fields and when it was taken in. A message that is not
    JSON, or has no body, becomes a row without any field."""
    fields = messages.select(message_fields("value", feed.schema).alias("data")).select("data.*")
    return fields.withColumn("ingestion_time", F.current_timestamp())


def start_feed(
    rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Run ``write`` on each micro-batch; a restart goes on from ``checkpoint``. With
    ``available_now`` the query stops once it has read what is there."""
    writer = rows.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_feeds(
    messages: Mapping[str, DataFrame],
    writers: Mapping[str, Callable[[DataFrame, int], None]],
    checkpoints: str,
    available_now: bool = False,
) -> None:
    """Run both feeds side by side until one fails or, with ``available_now``, all is read.

    ``messages`` and ``writers`` are given per topic; each feed keeps its own
    checkpoint, named after its table, below ``checkpoints``.
    """
    await_feeds(
        [
            start_feed(
                parse_messages(messages[feed.topic], feed),
                writers[feed.topic],
                f"{checkpoints.rstrip('/')}/{feed.table}",
                available_now,
            )
            for feed in (LOCATIONS, STATUSES)
        ]
    )


def await_feeds(queries: Sequence[StreamingQuery]) -> None:
    """Wait for all queries. The failure of any one is raised at once and stops the rest."""
    running = list(queries)
    try:
        while running:
            running = [q for q in running if not q.awaitTermination(1)]
    finally:
        for q in queries:
            q.stop()
