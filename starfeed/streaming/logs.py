"""Append logs that take each micro-batch once, also when it is run again after a failure."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from starfeed.sources.jdbc import Database
from starfeed.workspace import read_if_there, removed, written

QUERY, BATCH, DAY = "query_id", "batch_id", "day"


def query_id(batch: DataFrame) -> str:
    """The id of the streaming query that runs this batch: kept in its checkpoint, and another one with a new checkpoint.
    Batches written by hand are of one query named so."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "by-hand"


PUBLISHED = "published"
PUBLISHED_COLUMNS = f"number int, pieces array<struct<folder: string, level: int, {DAY}: date>>, upto map<string, long>, gone array<string>"


@dataclass(frozen=True)
class ParquetLog:
    """One folder per query and micro-batch, replaced when the batch is run again. Any number of
    queries, one after the other or at once, may write to a path, each with its own checkpoint.

    ``merge`` puts finished batches together into pieces, one folder for each day on which their messages were taken in, and pieces of a day into
    larger ones, ``fan`` at a time: n batches become about ``fan`` times the logarithm of n pieces a day, and a row is rewritten as often
    as that logarithm. It may run beside the queries, one merge at a time. Its last line says up to which batch of each query the pieces
    hold the rows, and which pieces count; a batch that its query may still run again, the last one, is never merged. Folders that it replaces
    are removed by the merge after next, so that readers who have begun can end.
    """

    path: str
    stamp: str = "ingestion_time"
    fan: int = 10

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/{QUERY}={query_id(batch)}/{BATCH}={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        last = self._published(spark)
        batches = self._rest(spark, last)
        pieces = [p["folder"] for p in last["pieces"]] if last else []
        parts = [batches.drop(QUERY, BATCH)] if batches is not None else []
        if pieces:
            parts.append(spark.read.parquet(*[f"{self._merged()}/{p}" for p in pieces]))
        if not parts:
            raise ValueError(f"no messages at {self.path} yet")
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def merge(self, spark: SparkSession) -> int:
        """Merges what is finished; returns how many batches that were."""
        last = self._published(spark)
        rest = self._rest(spark, last)
        if rest is None:
            return 0
        newest = {r[QUERY]: r[BATCH] for r in rest.select(QUERY, BATCH).groupBy(QUERY).agg(F.max(BATCH).alias(BATCH)).collect()}
        found = rest.select(QUERY, BATCH).distinct().collect()  # one line for each batch since the last merge
        done = [r for r in found if r[BATCH] < newest[r[QUERY]]]
        if not done:
            return 0
        number = (last["number"] if last else 0) + 1
        upto = dict(last["upto"]) if last else {}
        replaced = [f"{self.path}/{QUERY}={r[QUERY]}/{BATCH}={r[BATCH]}" for r in done]
        for r in done:
            upto[r[QUERY]] = max(upto.get(r[QUERY], -1), r[BATCH])
        rows = spark.read.parquet(*replaced)
        pieces = [(p["folder"], p["level"], p[DAY]) for p in last["pieces"]] if last else []
        pieces += self._pieces(rows, number, 0)
        for level in range(64):
            of_day: dict = {}
            for piece in pieces:
                if piece[1] == level:
                    of_day.setdefault(piece[2], []).append(piece)
            full = [p for group in of_day.values() if len(group) >= self.fan for p in group]
            if not full:
                break
            larger = self._pieces(spark.read.parquet(*[f"{self._merged()}/{p[0]}" for p in full]), number, level + 1)
            pieces = [p for p in pieces if p not in full] + larger
            replaced += [f"{self._merged()}/{p[0]}" for p in full]
        line = spark.createDataFrame([(number, pieces, upto, replaced)], PUBLISHED_COLUMNS)
        line.coalesce(1).write.mode("overwrite").parquet(f"{self._merged()}/{PUBLISHED}/at={number}")
        removed(spark, [*(last["gone"] if last else []), f"{self._merged()}/{PUBLISHED}/at={number - 2}"])
        return len(done)

    def _merged(self) -> str:
        return f"{self.path.rstrip('/')}-merged"

    def _published(self, spark: SparkSession) -> Row | None:
        """The line of the last merge."""
        lines = read_if_there(spark, f"{self._merged()}/{PUBLISHED}", PUBLISHED_COLUMNS)
        return None if lines is None else max(lines.collect(), key=lambda line: line["number"], default=None)

    def _rest(self, spark: SparkSession, last: Row | None) -> DataFrame | None:
        """The batches that no piece holds, with their query and number."""
        batches = read_if_there(spark, self.path)
        if batches is None:
            return None
        batches = batches.withColumns({QUERY: F.col(QUERY).cast("string"), BATCH: F.col(BATCH).cast("long")})
        for query, batch in (last["upto"] if last else {}).items():
            batches = batches.where((F.col(QUERY) != query) | (F.col(BATCH) > batch))
        return batches

    def _pieces(self, rows: DataFrame, number: int, level: int) -> list[tuple]:
        """Writes rows as one piece for each day."""
        base = f"merge={number}/level={level}"
        dated = rows.withColumn(DAY, F.to_date(self.stamp)).hint("rebalance", DAY)
        path = f"{self._merged()}/{base}"
        dated.write.mode("overwrite").partitionBy(DAY).parquet(path)
        days = rows.sparkSession.read.parquet(path).select(F.col(DAY).cast("date")).distinct().collect()
        return [(f"{base}/{DAY}={'__HIVE_DEFAULT_PARTITION__' if r[0] is None else r[0]}", level, r[0]) for r in days]


@dataclass(frozen=True)
class JdbcLog:
    """A database table whose rows carry their query and batch. The table of batches notes when one
    begins and when it is done: one that is done is skipped, and only of one that had begun before
    are stored rows looked for and the missing ones added."""

    database: Database
    table: str
    stamp: str = "ingestion_time"  # differs when a batch is run again

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark, number = batch.sparkSession, _number(query_id(batch))
        here = (F.col(QUERY) == number) & (F.col(BATCH) == batch_id)
        notes = f"{self.table}_batches"
        states = set()
        if self.database.exists(spark, notes):
            states = {row["done"] for row in self.database.read(spark, notes).where(here).select("done").collect()}
        if True in states:
            return
        if not states:
            self._note(spark, notes, number, batch_id, False)
        elif self.database.exists(spark, self.table):
            told_by = [c for c in batch.columns if c != self.stamp]
            stored = self.database.read(spark, self.table).where(here)
            missing = batch.select(told_by).exceptAll(stored.select(told_by))
            # worked out before the table changes, which a lost task would otherwise see
            missing = written(missing, "missing-messages")
            batch = missing.withColumn(self.stamp, F.current_timestamp()).select(batch.columns)
        marked = batch.withColumns({QUERY: F.lit(number), BATCH: F.lit(batch_id).cast("long")})
        self.database.append(marked, self.table)
        self._note(spark, notes, number, batch_id, True)

    def _note(self, spark: SparkSession, notes: str, number: int, batch_id: int, done: bool) -> None:
        line = spark.createDataFrame([(number, batch_id, done)], f"{QUERY} long, {BATCH} long, done boolean")
        self.database.append(line.coalesce(1), notes)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.database.read(spark, self.table).drop(QUERY, BATCH)


def _number(query: str) -> int:
    """A query's id as a number of 62 bits, which any database can compare."""
    return int.from_bytes(hashlib.sha256(query.encode()).digest()[:8], "big") >> 2
