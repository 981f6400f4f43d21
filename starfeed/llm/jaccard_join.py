"""Near-duplicate documents: MinHash banding, then exact Jaccard similarity on full word n-gram sets."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starfeed.llm.components import components
from starfeed.llm.text import WORD, WordHashes, columns, map_arrow, map_batches, mixed
from starfeed.workspace import written

BLOCK_DOCS, BLOCK_SHINGLES, COLUMNS = 1024, 1_000_000, 2048
#: How far below the threshold a pair's sketches may agree: with 100 places, five standard deviations.
SLACK = 0.2


def choose_bands(threshold: float, recall: float, most: int = 100) -> tuple[int, int]:
    """(bands, rows per band) with as many rows as ``most`` hashes allow, so that a pair
    at the threshold shares a band with probability ``recall`` at least."""
    best = None
    for rows in range(1, 33):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))) if threshold < 1 else 1
        if bands * rows <= most:
            best = bands, rows
    if best is None:
        raise ValueError(f"{most} hashes are too few for recall {recall} at similarity {threshold}")
    return best


def shingles(texts: list[str | None], n: int, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles of all texts, one after the other, and the count for each text.

    Words are lower-cased runs of non-space. A text of fewer than n words is one shingle, one without words none.
    """
    words, counts = [], []
    for text in texts:
        found = WORD.findall(text.lower()) if text else []
        words += found
        counts.append(len(found))
    counts = np.asarray(counts, np.int64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    ends = np.cumsum(counts)
    last = np.repeat(ends, counts)  # where the text of each word ends
    combined = h.copy()
    place = np.arange(len(h))
    for k in range(1, n):
        take = place + k < last
        combined[take] = combined[take] * np.uint64(0x100000001B3) + h[k:][take[: len(h) - k]] if k < len(h) else combined[take]
    position = place - np.repeat(ends - counts, counts)
    starts = (position == 0) | (place + n <= last)
    return mixed(combined[starts]), np.where(counts > 0, np.maximum(counts - n + 1, 1), 0)


def _signer(n: int, bands: int, rows: int):
    rng = np.random.default_rng(20_240_601)
    flips = rng.integers(0, 2**63, bands * rows, np.uint64)
    odds = rng.integers(0, 2**63, bands * rows, np.uint64) | np.uint64(1)
    hashes = WordHashes()

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, counts = shingles(batch.column("text").to_pylist(), n, hashes)
        full = counts > 0
        starts = (np.cumsum(counts) - counts)[full]
        out = np.zeros((int(full.sum()), bands), np.uint64)
        sketch = np.zeros((len(out), bands * rows), np.uint8)
        for band in range(bands):
            key = np.full(len(out), band + 1, np.uint64)
            for k in range(band * rows, band * rows + rows):
                if len(starts):
                    least = np.minimum.reduceat((found ^ flips[k]) * odds[k], starts)
                    key = mixed(key * np.uint64(0x100000001B3) + least)
                    sketch[:, k] = mixed(least) >> np.uint64(56)
            out[:, band] = key
        ends = np.cumsum(np.where(full, bands, 0))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(out.ravel().view(np.int64)))
        sketches = np.full(len(full), None, object)
        sketches[full] = [x.tobytes() for x in sketch]
        return pa.record_batch(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(counts), lists, pa.array(sketches, pa.binary())],
            ["doc_id", "text_key", "shingles", "bands", "sketch"],
        )

    return sign


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))).alias("text_key"),
        F.col(text_col).alias("text"),
    )


def _id_key(column: str) -> Column:
    """An id as text, empty for a null one: equal ids are equal keys, so that a join and a grouping by it share one shuffle."""
    return F.coalesce(F.col(column).cast("long").cast("string"), F.lit(""))


def _set_writer(n: int):
    hashes = WordHashes()

    def write(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, counts = shingles(batch.column("text").to_pylist(), n, hashes)
        sets = [np.unique(x).tobytes() for x in np.split(found, np.cumsum(counts)[:-1])]
        keep = [i for i, name in enumerate(batch.schema.names) if name != "text"]
        return pa.record_batch(
            [*(batch.column(i) for i in keep), pa.array(sets, pa.binary())], [*(batch.schema.names[i] for i in keep), "grams"]
        )

    return write


def _grouped(pick: Callable[[list[dict], bool], pa.RecordBatch | None]):
    """Runs ``pick`` on the rows of each (root, i, j) of a sorted input, in the order of their texts' keys, so that
    groups that meet in many buckets get one and the same root; its second argument tells whether i = j."""

    def picked(group: dict, key: tuple) -> pa.RecordBatch | None:
        return pick([group[k] for k in sorted(group)], key[1] == key[2]) if len(group) > 1 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, {}
        for batch in batches:
            for row in batch.to_pylist():
                now = row["root"], row["i"], row["j"]
                if now != key:
                    if (out := picked(group, key)) is not None:
                        yield out
                    key, group = now, {}
                group[row["text_key"]] = row
        if (out := picked(group, key)) is not None:
            yield out

    return run


def _between(rows: list[dict], same_block: bool, close: np.ndarray) -> np.ndarray:
    """Pairs of different texts; those inside a block belong to the task of that block alone."""
    if not same_block:
        side = np.asarray([r["block"] for r in rows])
        close &= side[:, None] != side[None, :]
    np.fill_diagonal(close, False)
    return close


def _forest(close: np.ndarray) -> np.ndarray:
    """For each row the first row that it is connected to."""
    label = np.arange(len(close))
    while True:
        near = np.minimum(label, np.where(close, label[None, :], len(close)).min(1))
        near = near[near]
        if (near == label).all():
            return label
        label = near


def _alike(threshold: float):
    """Connects texts of one bucket whose sketches agree in at least ``threshold`` of their places."""

    def pick(rows: list[dict], same_block: bool) -> pa.RecordBatch | None:
        sketches = np.frombuffer(b"".join([r["sketch"] for r in rows]), np.uint8).reshape(len(rows), -1)
        close = np.zeros((len(rows), len(rows)), bool)
        step = max(1, 16_000_000 // sketches.size)
        for at in range(0, len(rows), step):
            close[at : at + step] = (sketches[at : at + step, None] == sketches[None]).mean(2) >= threshold
        label = _forest(_between(rows, same_block, close))
        joined = np.flatnonzero(label != np.arange(len(rows)))
        if not len(joined):
            return None
        keys = [r["text_key"] for r in rows]
        return pa.record_batch(
            [pa.array([keys[k] for k in joined], pa.binary()), pa.array([keys[label[k]] for k in joined], pa.binary())], ["a", "b"]
        )

    return _grouped(pick)


def _verifier(threshold: float):
    """Links the texts of a candidate group by their full sets of n-grams."""

    def pick(rows: list[dict], same_block: bool) -> pa.RecordBatch | None:
        sets = [np.frombuffer(r["grams"], np.uint64) for r in rows]
        sizes = np.asarray([len(s) for s in sets], np.float32)
        owner = np.repeat(np.arange(len(rows)), sizes.astype(np.int64))
        _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times[column] > 1  # a shingle of one text alone is in no intersection
        owner, (_, column) = owner[shared], np.unique(column[shared], return_inverse=True)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        common = np.zeros((len(rows), len(rows)), np.float32)
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            a, b = np.searchsorted(column, [low, low + COLUMNS])
            part = np.zeros((len(rows), COLUMNS), np.float32)
            part[owner[a:b], column[a:b] - low] = 1
            common += part @ part.T
        close = _between(rows, same_block, common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-4)
        links = close.sum(1)
        some = np.flatnonzero(links)
        if not len(some):
            return None
        label, keys = _forest(close), [r["text_key"] for r in rows]
        copies = np.asarray([r["copies"] for r in rows])
        return pa.record_batch(
            [
                pa.array([keys[k] for k in some], pa.binary()),
                pa.array([keys[label[k]] for k in some], pa.binary()),
                pa.array(links[some].astype(np.int64)),
                pa.array((close.astype(np.int64) @ copies)[some]),
            ],
            ["a", "b", "texts", "docs"],
        )

    return _grouped(pick)


def _tasks(rows: DataFrame) -> DataFrame:
    """Each row to the tasks (root, i, j) of its block and each block of its group, sorted by them."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = rows.select("*", other.alias("other")).drop("blocks")
    paired = paired.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")
    return paired.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")


def _block(blocks: str) -> Column:
    return F.pmod(F.xxhash64("text_key"), blocks).cast("int")


def jaccard_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    n: int = 5,
    recall: float = 0.9995,
) -> DataFrame:
    """One row per input row: doc_id, text_key, class_id, n_links, n_copies, keeps.

    Two different texts are linked if the Jaccard similarity of their sets of n-word shingles is
    ``threshold`` or more; a class is what links and equal texts connect, named by its least
    doc_id. ``n_links`` counts the linked documents of other texts, ``n_copies`` the rows with exactly this text,
    ``keeps`` marks the text that stands for its class (repeated rows of one id share the mark).

    Exact copies count once (they are grouped by text before anything is compared). Texts that share a band and
    whose MinHash sketches agree well enough form candidate groups; in these, full sets are compared. Buckets and groups
    are compared block by block, so a task holds two blocks of at most about 1,024 texts or a million shingles whatever
    the size of the group, and only counts of links and a spanning forest leave it, never all pairs.

    Nulls and texts without words have no shingles: each such row is a class of its own with
    no links. A null doc_id never names a class that has another one; a class of null ids only has a null name.
    """
    bands, rows = choose_bands(threshold, recall)
    keyed = _keyed(docs, id_col, text_col)
    signed = written(
        map_arrow(keyed, _signer(n, bands, rows), "doc_id long, text_key binary, shingles long, bands array<long>, sketch binary", "text"),
        "signatures",
    )
    texts = written(
        signed.where("shingles > 0").groupBy("text_key").agg(
            F.min("doc_id").alias("least_id"), F.count("*").alias("copies"), F.max("shingles").alias("shingles"),
            F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch"),
        ),
        "texts",
    )
    banded = texts.select("text_key", F.explode("bands").alias("root"))
    buckets = banded.groupBy("root").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("text_key")).alias("members")).where("size > 1")
    buckets = buckets.groupBy("size", "members").agg(F.min("root").alias("root"))  # of buckets with the same texts, one
    buckets = buckets.select("root", F.ceil(F.col("size") / BLOCK_DOCS).cast("int").alias("blocks"))
    colliding = banded.join(buckets, "root").join(texts.select("text_key", "sketch"), "text_key")
    alike = map_batches(_tasks(colliding.withColumn("block", _block("blocks"))), _alike(threshold - SLACK), "a binary, b binary")
    grouped = components(alike).withColumnRenamed("node", "text_key")

    grouped = grouped.join(texts.drop("bands", "sketch"), "text_key")
    blocks = grouped.groupBy("root").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    members = written(
        grouped.join(blocks, "root").select(
            "text_key", "root", "blocks", "copies", F.col("least_id").alias("of_id"),
            _block("blocks").alias("block"),
        ),
        "members",
    )
    # always by shuffle: one move of the texts, whatever the number of members
    needed = keyed.withColumn("id_key", _id_key("doc_id")).join(
        members.withColumn("id_key", _id_key("of_id")).hint("merge"), ["text_key", "id_key"]
    ).groupBy("text_key", "id_key").agg(*[F.first(c).alias(c) for c in ("text", "root", "blocks", "block", "copies")])
    sets = map_arrow(
        needed.select("text_key", "root", "blocks", "block", "copies", "text"), _set_writer(n),
        "text_key binary, root binary, blocks int, block int, copies long, grams binary", "text",
    )
    links = written(map_batches(_tasks(sets), _verifier(threshold), "a binary, b binary, texts long, docs long"), "links")

    counts = links.groupBy(F.col("a").alias("text_key")).agg(F.sum("docs").alias("n_links"))
    roots = components(links.select("a", "b")).withColumnRenamed("node", "text_key")
    classed = texts.select("text_key", "least_id", "copies").join(roots.join(counts, "text_key"), "text_key", "left")
    classed = classed.withColumn("root", F.coalesce("root", "text_key"))
    names = classed.groupBy("root").agg(F.min("least_id").alias("class_id"), F.min(F.struct(F.col("least_id").isNull(), "least_id", "text_key")).alias("first"))
    classed = classed.join(names, "root").select(
        "text_key", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("copies").alias("n_copies"),
        "least_id", (F.col("first.text_key") == F.col("text_key")).alias("keeps"),
    )
    plain = signed.where("shingles = 0").select(
        "doc_id", "text_key", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(1).cast("long").alias("n_copies"), F.lit(True).alias("keeps"),
    )
    full = signed.where("shingles > 0").select("doc_id", "text_key").join(classed, "text_key").select(
        "doc_id", "text_key", "class_id", "n_links", "n_copies", (F.col("keeps") & F.col("doc_id").eqNullSafe(F.col("least_id"))).alias("keeps")
    )
    return full.union(plain)


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row for each near-duplicate class, all columns kept. Rows without words all stay."""
    classes = jaccard_classes(docs, **options).where("keeps").select(F.col("text_key").alias("_key"), _id_key("doc_id").alias("_id"))
    classes = written(classes.distinct(), "kept")
    key = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    marked = docs.select(F.struct(*columns(docs)).alias("_row"), key.alias("_key"), _id_key("doc_id").alias("_id"))
    wordless = F.length(F.regexp_replace(F.coalesce(F.col("_row.text"), F.lit("")), "[\\x20\\x09-\\x0D]", "")) == 0
    worded = marked.where(~wordless).join(classes.hint("merge"), ["_key", "_id"], "left_semi")
    worded = worded.groupBy("_key", "_id").agg(F.first("_row").alias("_row"))
    return worded.select("_row.*").union(marked.where(wordless).select("_row.*"))
