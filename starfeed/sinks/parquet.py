"""A warehouse of Parquet tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from starfeed.functions.widening import as_type, fits, merged_schema
from starfeed.operators.incremental import PROBE_ROWS, high_water_mark, key_set, new_rows
from starfeed.operators.skew import skew_join
from starfeed.sinks.keys import KEY, KeyStore, key_of
from starfeed.workspace import read_if_there, written

LOG = "load_log"
#: ``number`` counts the loads; ``types`` is the schema of the load's rows, ``merged`` that of the table from this load on; ``keys`` tells
#: in which key store, under which attempts, the keys of which loads are.
LOG_COLUMNS = "load_id string, table string, rows long, mark date, number long, types string, merged string, keys string"
MONTH = "anio_mes"
KEY_COLUMN = "_key"


class ParquetWarehouse:
    """Tables below ``root``, one folder per load in each.

    A load becomes visible as a whole when its lines are added to the load log, after
    its last table is written. A load that was cut off stays invisible, does not move
    the mark, and running it again under its ``load_id`` replaces what it left behind. The log
    also has the latest date that a load brought to a dated table, so that finding the mark opens no data file.

    A column's type may change from load to load. The log records the schema of each load's rows, by which they are
    read, and that of the table from then on, in which a column has the narrowest type that holds all its values so far. Only where two
    numeric types do not tell whether one holds the other's values are those counted, once, when the load is published.

    A table of ``key_rows`` rows or more has a key store (see ``KeyStore``), so that finding unseen keys does not move its history.
    It is made up when the first load needs it, and extended by each load's new keys.

    ``months`` names, per table, the date column whose month the table is partitioned by.
    """

    def __init__(self, spark: SparkSession, root: str, months: Mapping[str, str] | None = None, key_rows: int = PROBE_ROWS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.key_rows = key_rows
        self.key_store = KeyStore(spark, f"{self.root}/key_store")
        self.months = {"fact_pedidos": "fecha_pedido"} if months is None else dict(months)
        self._latest: dict[tuple[str, str], date | None] = {}
        self._types: dict[tuple[str, str], T.StructType] = {}
        self._keyed: dict[tuple[str, str], tuple[str, Sequence[str]]] = {}
        self._attempts: dict[str, str] = {}

    def loads(self, condition: str = "true") -> list[Row]:
        """The lines of the load log that meet the condition, in order: one short line per table and load."""
        log = read_if_there(self.spark, f"{self.root}/{LOG}", LOG_COLUMNS)
        return [] if log is None else sorted(log.where(condition).collect(), key=lambda line: line["number"] or 0)

    def stored(self, table: str, columns: Sequence[str] | None = None, after: date | None = None) -> DataFrame | None:
        """The rows of all finished loads; None if there is no such table. ``after``
        keeps rows dated later, reading only the months that can hold them."""
        df = self._read(table)
        if df is None:
            return None
        if after is not None:
            day = self.months[table]
            df = df.where((F.col(MONTH) >= after.year * 100 + after.month) & (F.col(day) > F.lit(after)))
        if MONTH in df.columns and table in self.months:
            df = df.drop(MONTH)
        return df if columns is None else df.select(*columns)

    def mark(self, table: str, column: str) -> Any:
        """The largest ``column``. For a table's date column the log has it; rows without any date are an error."""
        dated = self.months.get(table) == column
        filled = self.loads(f"table = '{table}' and rows > 0") if dated else []
        if filled and all(line["mark"] is not None for line in filled):
            return max(line["mark"] for line in filled)
        return high_water_mark(self._read(table), column, partition=MONTH if dated else None)

    def append(self, table: str, df: DataFrame, load_id: str) -> int:
        """Write this load's rows of one table, replacing those of an earlier try."""
        path = self._folder(table, load_id)
        day = self.months.get(table)
        if day is None:
            df.write.mode("overwrite").parquet(path)
        else:
            # rebalance: whole files per month, a month with very many rows split over tasks
            dated = df.withColumn(MONTH, F.year(day) * 100 + F.month(day)).hint("rebalance", MONTH)
            dated.write.mode("overwrite").partitionBy(MONTH).parquet(path)
        self._types[load_id, table] = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
        written = self.spark.read.schema(df.schema).parquet(path)
        rows = written.count()  # from the file footers
        if day is not None and rows:
            own = self.spark.read.parquet(path).where(F.col(day).isNotNull())
            self._latest[load_id, table] = high_water_mark(own, day, partition=MONTH)
        return rows

    def unseen(self, table: str, df: DataFrame, keys: Sequence[str], load_id: str, null_safe: bool, probe: int, probe_rows: int) -> DataFrame:
        """The rows of ``df`` whose key is not stored (see ``new_rows``, also for the limits). With a key store the extract's keys go to the stored
        ones, and ``df`` is cut to the unseen ones where it is read, if these are few."""
        lines = self.loads(f"table = '{table}'")
        filled = [line for line in lines if line["rows"]]
        if not filled:
            return df
        total = sum(line["rows"] for line in filled)
        if not null_safe or total < self.key_rows:
            return new_rows(df, self.stored(table, keys), keys, null_safe, probe=probe, probe_rows=probe_rows)
        name = "-".join([table, *keys])
        self._keyed[load_id, table] = name, keys
        attempts, rest = self._attempts_of(name, lines)
        if rest:  # loads from before there was a store
            past = self._rows(table, rest, self._schema(table, lines)).select(*keys)
            past = past.select(key_of(past, keys).alias(KEY)).distinct()
            self.key_store.add(name, past, attempt := f"{self._attempt(load_id)}-past", total)
            attempts.append(attempt)
        rows = df.withColumn(KEY_COLUMN, key_of(df, keys))
        asked = rows.select(F.col(KEY_COLUMN).alias(KEY)).distinct()
        n = df.count()
        if n < probe_rows:
            seen = self.key_store.seen(name, asked, attempts, n).select(F.col(KEY).alias(KEY_COLUMN))
            return skew_join(rows, seen, KEY_COLUMN, "left_anti").drop(KEY_COLUMN)
        unseen = written(self.key_store.unseen(name, asked, attempts).withColumnRenamed(KEY, KEY_COLUMN), "unseen-keys")
        return key_set(unseen, probe).cut(rows).drop(KEY_COLUMN)

    def _attempts_of(self, name: str, lines: Sequence[Row]) -> tuple[list[str], list[Row]]:
        """The published attempts in a key store, and the loads whose keys it does not have."""
        notes = [n for n in (json.loads(line["keys"]) for line in lines if line["keys"]) if n["store"] == name]
        covered = {load for n in notes for load in n["loads"]}
        rest = [line for line in lines if line["rows"] and line["load_id"] not in covered]
        return [a for n in notes for a in n["attempts"]], rest

    def _attempt(self, load_id: str) -> str:
        return self._attempts.setdefault(load_id, uuid.uuid4().hex)

    def _key_note(self, table: str, lines: Sequence[Row], load_id: str, rows: int) -> str | None:
        """Adds the load's own keys to the table's store, if this load has one, and says what is in there now."""
        if (load_id, table) not in self._keyed:
            return None
        name, keys = self._keyed[load_id, table]
        attempts, rest = self._attempts_of(name, lines)
        added = [f"{self._attempt(load_id)}-past"] if rest else []
        # all but this load's own keys, which do not count before it is published
        self.key_store.tidy(name, attempts + added, rows + sum(line["rows"] for line in lines))
        if rows:
            own = self.spark.read.schema(self._types[load_id, table]).parquet(self._folder(table, load_id))
            self.key_store.add(name, own.select(key_of(own, keys).alias(KEY)).distinct(), self._attempt(load_id), rows)
            added.append(self._attempt(load_id))
        elif not rest:
            return None
        return json.dumps({"store": name, "attempts": added, "loads": [load_id, *(line["load_id"] for line in rest)]})

    def begin(self, load_id: str) -> None:
        if any(line["load_id"] == load_id for line in self.loads()):
            raise ValueError(f"load {load_id} is finished; writing it again would replace its rows")
        self._attempts[load_id] = uuid.uuid4().hex  # what an earlier try has added to key stores does not count

    def finish(self, load_id: str, rows: Mapping[str, int]) -> None:
        """Publish the load: all its tables at once."""
        before = self.loads()
        number = max((line["number"] or 0 for line in before), default=0) + 1
        lines = []
        for table, n in rows.items():
            own = self._types.get((load_id, table)) or self._types_of(table, load_id)
            past = [line for line in before if line["table"] == table]
            merged = self._merged(table, past, load_id, own, n)
            keys = self._key_note(table, past, load_id, n)
            lines.append((load_id, table, n, self._latest.get((load_id, table)), number, own.json(), merged.json(), keys))
        log = self.spark.createDataFrame(lines, LOG_COLUMNS)
        log.coalesce(1).write.mode("append").parquet(f"{self.root}/{LOG}")

    def _folder(self, table: str, load_id: str) -> str:
        return f"{self.root}/{table}/load_id={load_id}"

    def _types_of(self, table: str, load_id: str, recorded: str | None = None) -> T.StructType:
        """The schema of a load's rows, from the files where the log does not have it."""
        if recorded is not None:
            return T.StructType.fromJson(json.loads(recorded))
        found = self.spark.read.parquet(self._folder(table, load_id)).schema
        return T.StructType([f for f in found.fields if f.name != MONTH])

    def _merged(self, table: str, lines: Sequence[Row], load_id: str, own: T.StructType, rows: int) -> T.StructType:
        """The table's schema when the load's rows join those of ``lines``. A load or table without rows has no say."""
        before = self._schema(table, lines)
        if before is None or not any(line["rows"] for line in lines):
            return own
        if before == own or not rows:
            return before

        def measured(side: str, column: str, kind: T.DataType, wide: T.DataType) -> bool:
            if side == "own":
                values = self.spark.read.schema(own).parquet(self._folder(table, load_id))
            else:
                values = self._rows(table, lines, before)
            return values.where(~fits(F.col(f"`{column}`"), kind, wide)).isEmpty()

        return merged_schema(before, own, measured)

    def _schema(self, table: str, lines: Sequence[Row]) -> T.StructType | None:
        if not lines:
            return None
        last = lines[-1]
        if last["merged"] is not None:
            return T.StructType.fromJson(json.loads(last["merged"]))
        return self._types_of(table, next((line for line in lines if line["rows"]), lines[0])["load_id"])

    def _read(self, table: str) -> DataFrame | None:
        lines = self.loads(f"table = '{table}'")
        schema = self._schema(table, lines)
        return None if schema is None else self._rows(table, lines, schema)

    def _rows(self, table: str, lines: Iterable[Row], schema: T.StructType) -> DataFrame:
        """The loads' rows, each read by its own schema and cast to the table's; loads of one schema are one scan."""
        lines = list(lines)
        by_types: dict[str, list[str]] = {}
        for line in [x for x in lines if x["rows"]] or lines[:1]:
            own = self._types_of(table, line["load_id"], line["types"])
            by_types.setdefault(own.json(), []).append(line["load_id"])
        parts = []
        for recorded, load_ids in by_types.items():
            own = T.StructType.fromJson(json.loads(recorded))
            reader = self.spark.read.schema(own).option("basePath", f"{self.root}/{table}")
            part = reader.parquet(*[self._folder(table, load_id) for load_id in load_ids])
            months = [c for c in (MONTH,) if c in part.columns and c not in own.fieldNames()]
            kinds = {f.name: f.dataType for f in own.fields}
            values = [
                (as_type(F.col(f"`{f.name}`"), kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in schema.fields
            ]
            parts.append(part.select(*values, *[F.col(c).cast("int") for c in months]))
        return reduce(DataFrame.unionByName, parts)
