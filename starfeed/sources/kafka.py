"""Message streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """The stream of one Kafka topic, with the broker's ``key``, ``value`` and
    bookkeeping columns. Needs Spark's Kafka connector on the class path.
    ``max_per_trigger`` bounds a micro-batch after a long stop."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()
