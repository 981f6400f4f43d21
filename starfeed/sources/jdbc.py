"""Warehouse tables in a database."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F, types as T


SPLITTABLE = (T.NumericType, T.DateType, T.TimestampType)


@dataclass(frozen=True)
class Database:
    """How to reach a database over JDBC.

    ``lookup`` is the statement that returns a row if ``{table}`` exists, in the
    database's own dialect; a failing connection is thereby never taken for a
    missing table. ``options`` go to Spark's JDBC source and sink as they are
    (``batchsize``, ``fetchsize``, ``numPartitions``, ...).
    """

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str = "org.postgresql.Driver"
    lookup: str = (
        "select table_name from information_schema.tables "
        "where table_schema = current_schema() and table_name = '{table}'"
    )
    options: Mapping[str, str] = field(default_factory=dict)

    def settings(self) -> dict[str, str]:
        login = {"user": self.user, "password": self.password}
        return {
            "url": self.url,
            "driver": self.driver,
            **{k: v for k, v in login.items() if v is not None},
            **self.options,
        }

    def query(self, spark: SparkSession, sql: str) -> DataFrame:
        """The result of a statement the database runs itself."""
        return spark.read.format("jdbc").options(**self.settings()).option("query", sql).load()

    def exists(self, spark: SparkSession, table: str) -> bool:
        return not self.query(spark, self.lookup.format(table=table)).isEmpty()

    def largest(self, spark: SparkSession, table: str, column: str, where: str = "1 = 1") -> Row:
        """``mark`` = max(column) and ``n`` = count(*) of the rows that meet ``where``, computed by the database."""
        return self.query(spark, f'select max("{column}") as "mark", count(*) as "n" from {table} where {where}').first()

    def count(self, spark: SparkSession, table: str, where: str) -> int:
        """How many rows meet ``where``, counted by the database."""
        return self.query(spark, f'select count(*) as "n" from {table} where {where}').first()["n"]

    def read(
        self,
        spark: SparkSession,
        table: str,
        columns: Sequence[str] | None = None,
        split_on: str | None = None,
        partitions: int = 32,
    ) -> DataFrame:
        """A stored table; only ``columns`` are fetched. With ``split_on``, a column
        without heavy values, it is read over ``partitions`` connections in equal ranges if the
        column is a number, a date or a timestamp."""
        reader = spark.read.format("jdbc").options(**self.settings()).option("dbtable", table)
        kinds = {f.name: f.dataType for f in reader.load().schema.fields} if split_on is not None else {}
        if isinstance(kinds.get(split_on), SPLITTABLE):
            ends = self.query(
                spark, f'select min("{split_on}") as "low", max("{split_on}") as "high" from {table}'
            ).first()
            if ends["low"] is not None:
                reader = reader.options(
                    partitionColumn=f'"{split_on}"',
                    lowerBound=str(ends["low"]),
                    upperBound=str(ends["high"]),
                    numPartitions=partitions,
                )
        df = reader.load()
        return df if columns is None else df.select(*columns)

    def append(self, df: DataFrame, table: str) -> int:
        """Add rows by column name, creating the table the first time; returns how many.
        Each task is one transaction; ``numPartitions`` caps the connections."""
        # all columns nullable in the created table, so that a later load may lack one
        empty = df.sparkSession.createDataFrame(
            [], T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
        )
        added = Observation()
        (
            df.unionByName(empty)
            .observe(added, F.count(F.lit(1)).alias("n"))
            .write.format("jdbc")
            .options(**self.settings())
            .option("dbtable", table)
            .mode("append")
            .save()
        )
        return added.get["n"]
