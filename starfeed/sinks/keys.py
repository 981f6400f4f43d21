"""The keys of stored rows, kept so that a load finds its unseen ones without moving the history."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from starfeed.functions.widening import key_text
from starfeed.workspace import read_if_there, removed

KEY = "k"
#: About so many keys to a bucket, and so many loads before their files are put together.
BUCKET_KEYS, LOADS = 500_000, 100
#: So many keys of an extract at most are named in a query.
NAMED_KEYS = 1000
NOTES, NOTE_COLUMNS = "notes", "generation int, buckets int, covers array<string>"
BASE = "base"


def key_of(df: DataFrame, keys: Sequence[str]) -> Column:
    """The key columns as one text, which is the same whatever types they have in one extract (see ``key_text``); a NULL is a value of its own."""
    parts = []
    for k in keys:
        text = key_text(F.col(f"`{k}`"), df.schema[k].dataType)
        told = F.concat(F.lit("="), text) if len(keys) == 1 else F.concat(F.length(text).cast("string"), F.lit("="), text)
        parts.append(F.coalesce(told, F.lit("null")))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


class KeyStore:
    """Key sets below ``root``, one for each name, each a Parquet table in buckets by the hash of the key.

    The keys that a load adds carry its ``attempt``, and a reader names the attempts that count: those of a load that was cut off are not
    seen. Joined with the keys of an extract, the buckets stay where they are: only the extract's narrow keys are
    shuffled, to the store's buckets, and held there while the stored ones stream past.

    The number of buckets follows the number of keys. When the store has outgrown it, or its files are of many loads, ``tidy`` writes
    a new generation; the notes say which one counts, and the attempts it covers.
    """

    def __init__(self, spark: SparkSession, root: str, bucket_keys: int = BUCKET_KEYS, loads: int = LOADS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.bucket_keys = bucket_keys
        self.loads = loads

    def seen(self, name: str, keys: DataFrame, attempts: Sequence[str], rows: int | None = None) -> DataFrame | None:
        """Those of ``keys`` (one column ``k``, best distinct) that a load among ``attempts`` has added; None if there are no stored keys.
        The keys are dealt to the store's own buckets, or else Spark would deal the stored ones anew. If there are ``rows`` of
        them, and no more than ``NAMED_KEYS``, they are named in the query, which then opens only the buckets that they hit."""
        note = self._note(name)
        if note is None:
            return None
        if rows is not None and rows <= NAMED_KEYS:
            named = [row[KEY] for row in keys.distinct().collect()]
            return self._stored(name, note, attempts).where(F.col(KEY).isin(named)).distinct()
        asked = keys.repartition(note["buckets"], KEY).hint("shuffle_hash")
        return self._stored(name, note, attempts).join(asked, KEY, "left_semi").distinct()

    def unseen(self, name: str, keys: DataFrame, attempts: Sequence[str]) -> DataFrame:
        """Those of the distinct ``keys`` that no load among ``attempts`` has added, by one pass over both sides: the keys, dealt to the
        store's buckets, are held there and given out where no stored one that streams past is equal."""
        note = self._note(name)
        if note is None:
            return keys
        asked = keys.repartition(note["buckets"], KEY).hint("shuffle_hash")
        stored = self._stored(name, note, attempts).select(F.col(KEY).alias("_stored"))
        return asked.join(stored, F.col(KEY) == F.col("_stored"), "left").where(F.col("_stored").isNull()).select(KEY)

    def _stored(self, name: str, note: Row, attempts: Sequence[str]) -> DataFrame:
        counted = [BASE, *(a for a in attempts if a not in note["covers"])]
        return self._table(name, note["generation"], note["buckets"]).where(F.col("attempt").isin(counted)).select(KEY)

    def add(self, name: str, keys: DataFrame, attempt: str, rows: int) -> None:
        """Adds ``keys`` (one column ``k``), about ``rows`` of them; they count once the attempt is named."""
        note = self._note(name)
        if note is None:
            note = self._begin(name, 0, self._buckets(rows), [])
        self._write(name, note["generation"], note["buckets"], keys, attempt)

    def tidy(self, name: str, attempts: Sequence[str], rows: int) -> bool:
        """Puts the keys of ``attempts`` together in buckets of fitting number, if there are ``rows`` and the store has outgrown its buckets
        twice, or has files of many loads. One load at a time may do so."""
        note = self._note(name)
        if note is None:
            return False
        later = [a for a in attempts if a not in note["covers"]]
        buckets = self._buckets(rows)
        if buckets <= 2 * note["buckets"] and len(later) <= self.loads:
            return False
        generation, buckets = note["generation"] + 1, max(buckets, note["buckets"])
        self._drop(name, generation)  # what a try that was cut off has left
        self._write(name, generation, buckets, self._stored(name, note, attempts), BASE)
        self._begin(name, generation, buckets, list(attempts))
        if generation > 1:
            self._drop(name, generation - 2)  # a reader may still be at the last one
        return True

    # ---- files ----

    def _buckets(self, rows: int) -> int:
        return min(10_000, rows // self.bucket_keys + 1)

    def _note(self, name: str) -> Row | None:
        notes = read_if_there(self.spark, f"{self.root}/{NOTES}/{name}", NOTE_COLUMNS)
        return None if notes is None else max(notes.collect(), key=lambda n: n["generation"], default=None)

    def _begin(self, name: str, generation: int, buckets: int, covers: list[str]) -> Row:
        line = self.spark.createDataFrame([(generation, buckets, covers)], NOTE_COLUMNS)
        line.coalesce(1).write.mode("append").parquet(f"{self.root}/{NOTES}/{name}")
        return line.first()

    def _folder(self, name: str, generation: int) -> str:
        return f"{self.root}/{name}/generation={generation}"

    def _name(self, name: str, generation: int) -> str:
        return "starfeed_keys_" + hashlib.sha256(self._folder(name, generation).encode()).hexdigest()[:24]

    def _table(self, name: str, generation: int, buckets: int) -> DataFrame:
        """The buckets as the session's catalogue has to know them: Spark tells which file is of which bucket from the files' names."""
        table, folder = self._name(name, generation), self._folder(name, generation).replace("'", "\\'")
        self.spark.sql(
            f"create table if not exists {table} ({KEY} string, attempt string) using parquet "
            f"clustered by ({KEY}) into {buckets} buckets location '{folder}'"
        )
        self.spark.catalog.refreshTable(table)
        return self.spark.table(table)

    def _write(self, name: str, generation: int, buckets: int, keys: DataFrame, attempt: str) -> None:
        self._table(name, generation, buckets)
        dealt = keys.select(KEY, F.lit(attempt).alias("attempt")).repartition(buckets, KEY)
        dealt.write.format("parquet").bucketBy(buckets, KEY).mode("append").saveAsTable(self._name(name, generation))

    def _drop(self, name: str, generation: int) -> None:
        self.spark.sql(f"drop table if exists {self._name(name, generation)}")
        removed(self.spark, [self._folder(name, generation)])
