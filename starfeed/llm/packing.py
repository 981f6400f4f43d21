"""Concatenate-and-cut packing of token ids into fixed windows, by two passes of prefix sums."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from starfeed.llm.text import chunks, map_batches
from starfeed.llm.vocabulary import Encoder
from starfeed.workspace import written

WINDOW = 2048
END_ID = 1


def tokenized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """First pass: (doc_id, ids, part, part_offset) for each row, written to the shared folder.

    ``ids`` are the document's token ids and one ``end_id`` as little-endian unsigned 32-bit numbers;
    ``part_offset`` counts the ids before them in the partition ``part``. Written once, so the
    numbering is that of one run of each task and stays as it is when executors are lost.
    A null text is empty.
    """
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, offset, end = Encoder(path), TaskContext.get().partitionId(), 0, np.uint32(end_id)
        for batch in chunks(batches, "text"):
            ids = [np.append(encoder.one(x), end).astype("<u4") for x in batch.column("text").to_pylist()]
            sizes = np.asarray([len(x) for x in ids], np.int64)
            ends = offset + np.cumsum(sizes)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array([x.tobytes() for x in ids], pa.binary()),
                 pa.array(np.full(len(ids), part, np.int32)), pa.array(ends - sizes)],
                ["doc_id", "ids", "part", "part_offset"],
            )
            offset = int(ends[-1])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return written(map_batches(source, run, "doc_id long, ids binary, part int, part_offset long"), "tokens")


def placed(tokens: DataFrame) -> DataFrame:
    """Second pass: the global offset of each document, from prefix sums over the partitions' totals.

    There is one total for each partition, so the driver adds up as many numbers as there are tasks.
    """
    totals = tokens.groupBy("part").agg(F.sum(F.length("ids") / 4).cast("long").alias("total")).orderBy("part").collect()
    bases, base = [], 0
    for row in totals:
        bases.append((row["part"], base))
        base += row["total"]
    frame = tokens.sparkSession.createDataFrame(bases, "part int, base long")
    return tokens.join(F.broadcast(frame), "part").select("doc_id", "ids", (F.col("base") + F.col("part_offset")).alias("first"))


def cut(placed_tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """Boundary records: one row for each piece of a document in a window, with its ids.

    Window k holds the global offsets from k * window on. All windows but the last are full.
    """
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "ids"):
            out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
            for doc_id, ids, first in zip(*(batch.column(i).to_pylist() for i in range(3))):
                total, at = len(ids) // 4, 0
                while at < total:
                    sequence, offset = divmod(first + at, window)
                    length = min(window - offset, total - at)
                    piece = ids[4 * at : 4 * (at + length)]
                    for name, value in zip(out, (doc_id, at, length, zlib.crc32(piece), total, sequence, offset, piece)):
                        out[name].append(value)
                    at += length
            yield pa.record_batch(
                [pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in out.items()], list(out)
            )

    return map_batches(placed_tokens, run, schema)


def pack(docs: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """The pieces of all documents. Repeated rows are packed as often as they occur; an empty
    text is its end id alone; a text of any length is encoded whole, and a task holds its ids; an empty table gives no pieces."""
    return cut(placed(tokenized(docs, **options)), window)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids array<long>): the windows' ids put together from the pieces, at most one window of ids to a group."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.expr("hex(aggregate(pieces, cast('' as binary), (a, p) -> concat(a, p.ids)))")
    word = F.expr(
        "transform(sequence(0, length(h) div 8 - 1), i -> cast(conv(concat(substr(h, 8*i+7, 2), substr(h, 8*i+5, 2), substr(h, 8*i+3, 2), substr(h, 8*i+1, 2)), 16, 10) as long))"
    )
    grouped = pieces.groupBy("sequence_id").agg(ordered.alias("pieces"))
    return grouped.select("sequence_id", joined.alias("h")).select("sequence_id", word.alias("ids"))
