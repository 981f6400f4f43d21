"""A warehouse in a database."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from datetime import date
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starfeed.functions.widening import as_type, fits, holds, merged_schema
from starfeed.operators.incremental import new_rows
from starfeed.sources.jdbc import Database
from starfeed.workspace import written

LOG = "load_log"
#: One line for each table and attempt that some rows of which are stored twice.
COPIES = "load_copies"
ATTEMPT, ROW = "load_attempt", "load_row"
# The key of each table, by whose ranges it is read in parallel where it is a number or a date.
SPLIT_ON = {
    "dim_clientes": "cliente_id", "dim_wallets": "cliente_id", "dim_productos": "producto_id",
    "dim_repartidores": "repartidor_id", "dim_ubicaciones": "timestamp", "dim_sesiones": "fecha_inicio",
    "dim_transacciones": "id", "dim_wallets_blockchain": "id", "dim_tenants": "tenant_id",
    "dim_catalogos": "catalogo_id", "dim_promociones": "promocion_id", "dim_imagenes_producto": "imagen_id",
    "dim_datos_contacto": "contacto_id", "dim_fecha": "fecha", "dim_ratings": "rating_id",
    "dim_pedidos_delivery": "pedido_id", "fact_pedidos": "pedido_id", "fact_ratings": "rating_id",
}


class JdbcWarehouse:
    """Tables of one database, appended to over JDBC.

    Several tables cannot be published at once over JDBC. Each row therefore carries the attempt that wrote it, and
    the load log says which attempts began and which finished. Readers leave out the rows of attempts that
    did not finish, so a load that was cut off is invisible, does not move the mark, and is run again
    from the start as another attempt. What it left may be deleted at any time. Rows without an attempt, which something else has
    stored, count.

    Spark's writer commits task by task, and a task that is lost right after its commit is run again. Each row therefore carries its number in
    the attempt, and once a table is written the database counts what it has of the attempt: if that is more than was sent, it is noted, and
    readers take each number of that attempt once.

    A column keeps its type in a database. Rows that do not fit the table as it is, by a type or by a column, go into
    another table of the same name with ``_2``, ``_3`` and so on; readers take all of them, each column in the narrowest type that holds its values.
    A table without the columns of attempt and number, made by something else, is read and left as it is.

    ``split_on`` names, per table, the column to read it in parallel by (see ``SPLIT_ON``).
    ``days`` names, per table, its date column.
    """

    def __init__(
        self,
        spark: SparkSession,
        database: Database,
        split_on: Mapping[str, str] | None = None,
        partitions: int = 32,
        days: Mapping[str, str] | None = None,
    ):
        self.spark = spark
        self.database = database
        self.split_on = {**SPLIT_ON, **(split_on or {})}
        self.partitions = partitions
        self.days = {"fact_pedidos": "fecha_pedido"} if days is None else dict(days)
        self._attempts: dict[str, int] = {}
        self._cut_off: list[int] | None = None  # while a load runs, which alone could change it

    def stored(self, table: str, columns: Sequence[str] | None = None, after: date | None = None) -> DataFrame | None:
        parts = []
        for name in self._names(table):
            df = self.database.read(self.spark, name, None, self.split_on.get(table), self.partitions)
            if after is not None:
                df = df.where(F.col(self.days[table]) > F.lit(after))
            parts.append(self._visible(name, df))
        if not parts:
            return None
        df = self._in_one_schema(parts)
        return df if columns is None else df.select(*columns)

    def mark(self, table: str, column: str) -> Any:
        """The largest ``column``, found by the database itself."""
        found = []
        for name in self._names(table):
            cut_off = ", ".join(map(str, self.unfinished()))
            known = cut_off and ATTEMPT in self.database.read(self.spark, name).columns
            row = self.database.largest(self.spark, name, column, f'"{ATTEMPT}" is null or "{ATTEMPT}" not in ({cut_off})' if known else "1 = 1")
            if row["n"] and row["mark"] is None:
                raise ValueError(f"stored rows have no {column}: cannot tell what is loaded")
            found.append(row["mark"])
        return max((m for m in found if m is not None), default=None)

    def unseen(self, table: str, df: DataFrame, keys: Sequence[str], load_id: str, null_safe: bool, probe: int, probe_rows: int) -> DataFrame:
        """The rows of ``df`` whose key is not stored (see ``new_rows``, also for the limits)."""
        return new_rows(df, self.stored(table, keys), keys, null_safe, probe=probe, probe_rows=probe_rows)

    def append(self, table: str, df: DataFrame, load_id: str) -> int:
        """Work the rows out first, as files, and then copy them: what is new must not be
        asked of the table again while it is being written, as a lost task would."""
        if load_id not in self._attempts:
            raise ValueError(f"load {load_id} has not begun")
        attempt = self._attempts[load_id]
        marked = df.withColumns({ATTEMPT: F.lit(attempt), ROW: F.monotonically_increasing_id()})
        staged = written(marked, f"staged-{table}")
        rows = staged.count()  # from the file footers
        name = self._table_for(table, staged.schema)
        self.database.append(staged, name)
        there = self.database.count(self.spark, name, f'"{ATTEMPT}" = {attempt}')
        if there < rows:
            raise RuntimeError(f"{name}: {rows} rows were sent and {there} are stored")
        if there > rows:
            line = self.spark.createDataFrame([(name, attempt)], "stored_in string, attempt long")
            self.database.append(line.coalesce(1), COPIES)
        return rows

    def unfinished(self) -> list[int]:
        """The attempts that began and did not finish: those cut off, and one that is running."""
        if self._cut_off is not None:
            return self._cut_off
        if not self.database.exists(self.spark, LOG):
            return []
        attempts = self.database.read(self.spark, LOG).groupBy("attempt").agg(F.max(F.col("finished").cast("int")).alias("done"))
        return sorted(row["attempt"] for row in attempts.where("done = 0").collect())

    def begin(self, load_id: str) -> None:
        if self.database.exists(self.spark, LOG):
            # compared here and not in the database, where text may be of a type that cannot be compared
            same = F.concat("load_id", F.lit("")) == load_id
            done = self.database.read(self.spark, LOG).where(same).where(F.col("finished"))
            if not done.isEmpty():
                raise ValueError(f"load {load_id} is finished; running it again would add nothing but copies")
        self._attempts[load_id] = uuid.uuid4().int >> 66  # 62 bits
        self._note(load_id, False)
        self._cut_off = None
        self._cut_off = self.unfinished()

    def finish(self, load_id: str, rows: Mapping[str, int]) -> None:
        """Publish the load: all its tables at once."""
        self._note(load_id, True)
        self._cut_off = None

    def _note(self, load_id: str, finished: bool) -> None:
        line = [(load_id, self._attempts[load_id], finished)]
        log = self.spark.createDataFrame(line, "load_id string, attempt long, finished boolean")
        self.database.append(log.coalesce(1), LOG)

    # ---- tables of one name ----

    def _names(self, table: str) -> Iterator[str]:
        """The tables that hold the rows of one name."""
        name, n = table, 1
        while self.database.exists(self.spark, name):
            yield name
            n += 1
            name = f"{table}_{n}"

    def _table_for(self, table: str, schema: T.StructType) -> str:
        """The first table that takes rows of the schema as it is, or the name of a new one."""
        n = 0
        for n, name in enumerate(self._names(table), 1):
            kinds = {f.name: f.dataType for f in self.database.read(self.spark, name).schema.fields}
            if all(f.name in kinds and holds(kinds[f.name], f.dataType) and (kinds[f.name] != T.StringType() or f.dataType == T.StringType()) for f in schema.fields):
                return name
        return table if n == 0 else f"{table}_{n + 1}"

    def _visible(self, name: str, df: DataFrame) -> DataFrame:
        """The rows that count: of no attempt or one that finished, each once."""
        if ATTEMPT not in df.columns:
            return df
        if cut_off := self.unfinished():
            df = df.where(F.col(ATTEMPT).isNull() | ~F.col(ATTEMPT).isin(cut_off))  # runs in the database
        if ROW in df.columns and (doubled := self._doubled(name)):
            known = F.col(ATTEMPT).isin(doubled)
            df = df.where(F.col(ATTEMPT).isNull() | ~known).unionByName(df.where(known).dropDuplicates([ATTEMPT, ROW]))
        return df.drop(ATTEMPT, ROW)

    def _doubled(self, name: str) -> list[int]:
        if not self.database.exists(self.spark, COPIES):
            return []
        lines = self.database.read(self.spark, COPIES).where(F.concat("stored_in", F.lit("")) == name)
        return sorted(row["attempt"] for row in lines.collect())

    def _in_one_schema(self, parts: list[DataFrame]) -> DataFrame:
        schema = parts[0].schema
        for i, df in enumerate(parts[1:], 1):
            before = parts[:i]

            def measured(side: str, column: str, kind: T.DataType, wide: T.DataType) -> bool:
                tables = [df] if side == "own" else [x for x in before if column in x.columns]
                return all(x.where(~fits(F.col(f"`{column}`"), x.schema[column].dataType, wide)).isEmpty() for x in tables)

            schema = merged_schema(schema, df.schema, measured)

        def cast(df: DataFrame) -> DataFrame:
            kinds = {f.name: f.dataType for f in df.schema.fields}
            return df.select(
                *[
                    (as_type(F.col(f"`{f.name}`"), kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name)
                    for f in schema.fields
                ]
            )

        return reduce(DataFrame.unionByName, map(cast, parts)) if len(parts) > 1 else parts[0]
