"""Helpers that the operators on texts share: words, their hashes, and Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CHUNK_CHARS = 2_000_000
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


class WordHashes(dict):
    """word -> 64-bit hash as a Python int. Forgets all when ``limit`` words are held."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def rows_with(docs: DataFrame, keep: list[Column] | None, fields: dict[str, str]) -> DataFrame:
    """A struct ``_row`` of the ``keep`` columns and the ``fields`` (name -> column) beside it. Without ``keep`` the
    struct has all columns, and ``unpacked`` takes the fields from it, so that no text is sent to Python twice."""
    if keep is None:
        return docs.select(F.struct(*columns(docs)).alias("_row"))
    return docs.select(F.struct(*keep).alias("_row"), *[F.col(c).alias(name) for name, c in fields.items()])


def unpacked(batches: Iterable[pa.RecordBatch], fields: dict[str, str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_columns == 1:
            row = batch.column("_row")
            batch = pa.record_batch([row, *(row.field(c) for c in fields.values())], ["_row", *fields])
        yield batch


def chunks(batches: Iterable[pa.RecordBatch], text: str, chars: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that each piece holds about ``chars`` characters of text, and at least one row."""
    for batch in batches:
        sizes = np.diff(_offsets(batch.column(text)))
        groups = np.cumsum(sizes) // chars
        starts = np.flatnonzero(np.diff(groups, prepend=-1))
        for at, end in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(int(at), int(end - at))


def _offsets(column: pa.Array) -> np.ndarray:
    lengths = np.asarray(pc.fill_null(pc.binary_length(column), 0))
    return np.concatenate([[0], np.cumsum(lengths)])


def map_batches(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with batches of at most ``BATCH_BYTES``: ten thousand long texts would be
    a batch of a gigabyte. Sets the session's limit, which also holds for what it runs later."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def map_arrow(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: str) -> DataFrame:
    """``mapInArrow`` over pieces of bounded text size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, text):
            yield function(piece)

    return map_batches(df, run, schema)


def most_frequent(counted: DataFrame, n: str, most: int) -> DataFrame:
    """The rows with the highest ``n``, at most ``most`` of them. They are cut off at a sixteenth of an octave of ``n``, by a
    histogram of a thousand bars at most, so that no task and no driver sorts through what all tasks hold. ``counted`` is read twice."""
    step = F.floor(F.log2(n) * 16).cast("int")
    bars = counted.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).collect()
    total, least = 0, None
    for bar in sorted(bars, key=lambda b: -b["step"]):
        total += bar["rows"]
        if total > most:
            break
        least = bar["step"]
    return counted.where(F.lit(False)) if least is None else counted.where(step >= least)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads them evenly."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))
