"""The current state of a feed: the last message of each key."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from starfeed.operators.latest import last_of_batch
from starfeed.sources.jdbc import Database
from starfeed.streaming.logs import query_id
from starfeed.workspace import read_if_there, removed, written

PART, VERSION, CHANGE = "part", "version", "change"
FOLDED, FOLDED_COLUMNS = "folded", "part int, version int"


@dataclass(frozen=True)
class LatestState:
    """Upserts on Parquet, in ``parts`` by the hash of the key. Each micro-batch is reduced to one row per key and stored as
    changes of the parts it touches. A part is folded, that is, its changes are merged into a new full version of it, when they are more
    than ``share`` of its rows and ``least`` at that, or every ``fold_every`` batches if it has any by then; the other parts stay as they are. A batch so costs what it
    changes, and a reader takes of each part the last full version and the changes since, never the whole history. Versions before the last two
    are removed.

    ``order`` names the columns that decide which message is the last one; they should
    leave no ties. Late messages do not displace later ones. Messages without a key
    have no state. ``parts`` is also how many tasks write at once, so a large state takes more. Versions are counted in the state itself, so a query with a new checkpoint, or another
    ``fold_every``, goes on where the state is; ``parts`` stays as it was first. One query writes at a time. A batch
    that is run again after a part was folded becomes a change of its new version, which alters nothing.
    """

    path: str
    key: str
    order: Sequence[str]
    fold_every: int = 20
    parts: int = 8
    share: float = 0.25
    least: int = 100_000

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folded = self._folded(spark)
        changes = last_of_batch(batch.where(F.col(self.key).isNotNull()), self.key, self.order)
        part = F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.parts)).cast("int")
        versions = F.create_map(*[F.lit(x) for pair in folded.items() for x in pair]) if folded else None
        version = F.lit(0) if versions is None else F.coalesce(F.element_at(versions, F.col(PART)), F.lit(0))
        dealt = changes.withColumn(PART, part).withColumns({VERSION: version.cast("int"), CHANGE: F.lit(f"{query_id(batch)}-{batch_id}")})
        writer = dealt.repartition(PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(PART, VERSION, CHANGE).parquet(f"{self.path}/changes")
        if (batch_id + 1) % self.fold_every == 0:
            self._fold(spark, folded, self._changed(spark, folded))
        elif (batch_id + 1) % max(2, self.fold_every // 5) == 0:
            rows, changed = self._rows(spark, "full", folded), self._changed(spark, folded)
            self._fold(spark, folded, {p: n for p, n in changed.items() if p in folded and n > max(self.least, self.share * rows.get(p, 0))})

    def read(self, spark: SparkSession) -> DataFrame:
        folded = self._folded(spark)
        changed = self._changed(spark, folded)
        if not folded and not changed:
            raise ValueError(f"no state at {self.path} yet")
        return self._state(spark, folded, changed, {*folded, *changed})

    # ---- parts ----

    def _folded(self, spark: SparkSession) -> dict[int, int]:
        """part -> its last full version."""
        lines = read_if_there(spark, f"{self.path}/{FOLDED}", FOLDED_COLUMNS)
        return {} if lines is None else {r[PART]: r["last"] for r in lines.groupBy(PART).agg(F.max(VERSION).alias("last")).collect()}

    def _changed(self, spark: SparkSession, folded: Mapping[int, int]) -> dict[int, int]:
        """part -> the rows of its changes since."""
        return self._rows(spark, "changes", folded)

    def _rows(self, spark: SparkSession, kind: str, folded: Mapping[int, int]) -> dict[int, int]:
        """part -> the rows of its current version, counted from the files' footers."""
        rows = read_if_there(spark, f"{self.path}/{kind}")
        if rows is None:
            return {}
        counts = rows.groupBy(PART, VERSION).agg(F.count(F.lit(1)).alias("rows")).collect()
        return {r[PART]: r["rows"] for r in counts if r[VERSION] == folded.get(r[PART], 0)}

    def _state(
        self, spark: SparkSession, folded: Mapping[int, int], changed: Mapping[int, int], parts: Iterable[int]
    ) -> DataFrame:
        """The state of some parts; only those with changes are reduced."""
        def some(kind: str, wanted: Iterable[int]) -> list[DataFrame]:
            paths = [f"{self.path}/{kind}/{PART}={p}/{VERSION}={folded.get(p, 0)}" for p in sorted(wanted)]
            if not paths:
                return []
            df = spark.read.option("basePath", f"{self.path}/{kind}").parquet(*paths)
            return [df.drop(PART, VERSION, CHANGE)]

        parts = set(parts)
        still = some("full", [p for p in parts if p in folded and p not in changed])
        moved = some("full", [p for p in parts if p in folded and p in changed]) + some("changes", [p for p in parts if p in changed])
        if moved:
            still.append(last_of_batch(reduce(DataFrame.unionByName, moved), self.key, self.order))
        return reduce(DataFrame.unionByName, still)

    def _fold(self, spark: SparkSession, folded: Mapping[int, int], due: Mapping[int, int]) -> None:
        """Merges the changes of some parts into their next versions."""
        if not due:
            return
        versions = {p: folded.get(p, 0) + 1 for p in due}
        part = F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.parts)).cast("int")
        next_of = F.create_map(*[F.lit(x) for pair in versions.items() for x in pair])
        full = self._state(spark, folded, due, due).withColumn(PART, part).withColumn(VERSION, F.element_at(next_of, F.col(PART)))
        writer = full.repartition(PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(PART, VERSION).parquet(f"{self.path}/full")
        lines = spark.createDataFrame(list(versions.items()), FOLDED_COLUMNS)
        lines.coalesce(1).write.mode("append").parquet(f"{self.path}/{FOLDED}")
        old = [f"{PART}={p}/{VERSION}={v - 2}" for p, v in versions.items() if v >= 2]
        removed(spark, [f"{self.path}/{kind}/{folder}" for folder in old for kind in ("full", "changes")])


ATTEMPT, NOTE_COLUMNS = "attempt", "attempt long, era int, full boolean"


@dataclass(frozen=True)
class JdbcState:
    """The same upsert in a database that is only appended to.

    Each micro-batch is reduced to one row per key and added under an attempt of its own; the table of notes, written last, publishes it. Every
    ``fold_every`` batches the whole state is added as a new era. A reader takes the rows of the last era and of the attempts
    noted since, a bounded number that the database selects, and of each key the last by ``order``, so late messages do not displace later ones, a batch
    that was cut off is not seen, and one that is run again alters nothing. Rows of eras before the last may be deleted at any time.
    One query writes at a time; messages without a key have no state.
    """

    database: Database
    table: str
    key: str
    order: Sequence[str]
    fold_every: int = 20

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        era, _ = self._current(spark)
        self._add(spark, last_of_batch(batch.where(F.col(self.key).isNotNull()), self.key, self.order), era, False)
        if (batch_id + 1) % self.fold_every == 0:
            self._add(spark, self.read(spark), era + 1, True)

    def read(self, spark: SparkSession) -> DataFrame:
        _, attempts = self._current(spark)
        if not attempts:
            raise ValueError(f"no state in {self.table} yet")
        rows = self.database.read(spark, self.table).where(F.col(ATTEMPT).isin(attempts))
        return last_of_batch(rows.drop(ATTEMPT), self.key, self.order)

    def _current(self, spark: SparkSession) -> tuple[int, list[int]]:
        """The last era, and the attempts that make up the state."""
        notes = f"{self.table}_notes"
        if not self.database.exists(spark, notes):
            return 0, []
        lines = self.database.read(spark, notes)
        era = lines.agg(F.max("era")).first()[0]
        return era, sorted(row[ATTEMPT] for row in lines.where(F.col("era") == era).collect())

    def _add(self, spark: SparkSession, rows: DataFrame, era: int, full: bool) -> None:
        attempt = uuid.uuid4().int >> 66  # 62 bits
        # worked out before the table changes, which a lost task would otherwise see
        self.database.append(written(rows.withColumn(ATTEMPT, F.lit(attempt)), "changes"), self.table)
        note = spark.createDataFrame([(attempt, era, full)], NOTE_COLUMNS)
        self.database.append(note.coalesce(1), f"{self.table}_notes")
