"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations, multiprobe buckets, and verified pairs."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from starfeed.llm.components import components
from starfeed.llm.text import map_batches, mixed
from starfeed.workspace import written

THRESHOLD, RECALL = 0.9, 0.999
#: Vectors of a block: a task compares two blocks at most.
BLOCK = 1024
#: Axes a hash may be moved to: the nearest one and the next.
AXES = 3
MOST_HASHES, MOST_TABLES = 4, 200
SKETCH_BITS = 128
#: How many standard deviations above its mean the distance of two sketches may lie for a pair at the threshold.
SLACK = 5.5
#: Vectors hashed at a time.
ROWS = 1024


# ---- hashing ------------------------------------------------------------------------------


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the normalised Hadamard matrix, in n log n steps; their length is a power of two."""
    n, half = x.shape[1], 1
    while half < n:
        pairs = x.reshape(len(x), n // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(x), n)
        half *= 2
    return x / np.sqrt(np.float32(n))


def rotated(x: np.ndarray, number: int) -> np.ndarray:
    """A pseudo-random rotation: three rounds of random signs and a Hadamard transform."""
    signs = np.random.default_rng([20_260_101, number]).choice(np.float32([-1, 1]), (3, x.shape[1]))
    for flips in signs:
        x = hadamard(x * flips)
    return x


def padded(x: np.ndarray) -> np.ndarray:
    """Unit vectors of single precision, with zeros up to a power of two of 16 at least."""
    width = 1 << max(4, math.ceil(math.log2(x.shape[1])))
    out = np.zeros((len(x), width), np.float32)
    out[:, : x.shape[1]] = unit(x)
    return out


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no square of a large number, none of small ones alone
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def buckets_of(x: np.ndarray, table: int, hashes: int, probes: int) -> np.ndarray:
    """The ``probes`` buckets of each padded vector in a table that are nearest by cross-polytope hashes.

    A hash is the signed axis nearest to the rotated vector, and a bucket that of several hashes. Probes exchange axes for the next nearest, those with
    the least loss of squared distance first; the vector's own bucket is the first.
    """
    axes, losses = [], []
    for number in range(hashes):
        turned = rotated(x, table * MOST_HASHES + number)
        both = np.concatenate([turned, -turned], 1)
        top = np.argpartition(-both, AXES, 1)[:, :AXES]
        value = np.take_along_axis(both, top, 1)
        order = np.argsort(-value, 1, kind="stable")
        axes.append(np.take_along_axis(top, order, 1))
        value = np.take_along_axis(value, order, 1)
        losses.append((value[:, :1] - value) ** 2)
    moves = np.asarray(list(product(range(AXES), repeat=hashes)))
    loss = sum(losses[h][:, moves[:, h]] for h in range(hashes))
    best = np.argsort(loss, 1, kind="stable")[:, :probes]
    code = np.full(best.shape, table * 4096 + x.shape[1].bit_length(), np.uint64)
    for h in range(hashes):
        code = mixed(code * np.uint64(0x100000001B3) + np.take_along_axis(axes[h], moves[best][:, :, h], 1).astype(np.uint64))
    return code.view(np.int64)


@lru_cache(64)
def plan(length: int, rows: int, threshold: float, recall: float, pairs: int = 3000) -> tuple[int, int, int]:
    """(hashes, probes, tables) for vectors of a length: as many hashes as make random vectors of so many rows nearly alone in a bucket, and one table more than
    let a share ``recall`` of some ``pairs``, drawn at random at the threshold, meet in a bucket."""
    hashes, width = 1, 1 << max(4, math.ceil(math.log2(length)))
    while hashes < MOST_HASHES and (2 * width) ** hashes < 4 * rows * hashes:
        hashes += 1
    probes = min(2 * hashes, AXES**hashes)
    a, b = np.random.default_rng(7).normal(size=(2, pairs, max(2, length)))
    a = unit(a)
    b = unit(b - (a * b).sum(1, keepdims=True) * a)
    x, y = padded(a), padded(threshold * a + math.sqrt(1 - threshold**2) * b)
    tables = 0
    while len(x) > (1 - recall) * pairs:
        if tables == MOST_TABLES:
            raise ValueError(f"{tables} tables are too few for recall {recall} at cosine {threshold}")
        met = (buckets_of(x, tables, hashes, probes)[:, :, None] == buckets_of(y, tables, hashes, probes)[:, None, :]).any((1, 2))
        x, y = x[~met], y[~met]
        tables += 1
    return hashes, probes, tables + 1


def sketch_limit(threshold: float) -> int:
    """Sketches hold the signs of rotated vectors, so they differ in a share of angle / pi of their bits."""
    share = math.acos(threshold) / math.pi
    return math.ceil(SKETCH_BITS * share + SLACK * math.sqrt(SKETCH_BITS * share * (1 - share)))


def sketches(x: np.ndarray) -> np.ndarray:
    """Two longs of sign bits for each padded vector."""
    turns = -(-SKETCH_BITS // x.shape[1])
    signs = np.concatenate([rotated(x, -1 - t & 0xFFFF) for t in range(turns)], 1)[:, :SKETCH_BITS] > 0
    return np.packbits(signs, 1).view(np.int64)


def _matrices(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors) for each length of vector in a column without nulls."""
    lengths = np.diff(np.asarray(column.offsets))
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        for low in range(0, len(at), ROWS):
            some = at[low : low + ROWS]
            yield some, column.take(pa.array(some)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(some), length)


def _hasher(rows: int, threshold: float, recall: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _matrices(batch.column("vector")):
                hashes, probes, tables = plan(x.shape[1], rows, threshold, recall)
                x = padded(x)
                found = np.concatenate([buckets_of(x, t, hashes, probes) for t in range(tables)], 1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * found.shape[1]), pa.array(found.ravel()))
                s = sketches(x)
                yield pa.record_batch([batch.column("rid").take(pa.array(at)), pa.array(s[:, 0]), pa.array(s[:, 1]), lists], ["rid", "s1", "s2", "buckets"])

    return run


# ---- comparing -------------------------------------------------------------------------------


def _forest(close: np.ndarray) -> np.ndarray:
    """For each row the first one that it is connected to."""
    label = np.arange(len(close))
    while True:
        near = np.minimum(label, np.where(close, label[None, :], len(close)).min(1))
        near = near[near]
        if (near == label).all():
            return label
        label = near


def _tasks(pick: Callable[[pa.Table], np.ndarray], counted: bool):
    """Runs ``pick`` on the rows of each (root, i, j) of a sorted input; it tells which of them are close. Gives for each row that is close to another an edge (a, b) to
    the first that it is connected to and, where ``counted``, how many vectors it is close to. Pairs in one block are of the block's own task alone."""

    def compared(parts: list[pa.RecordBatch]) -> list[np.ndarray]:
        rows = pa.Table.from_batches(parts)
        close = pick(rows)
        block = rows.column("block").to_numpy()
        if rows.column("i")[0].as_py() != rows.column("j")[0].as_py():
            close &= block[:, None] != block[None, :]
        np.fill_diagonal(close, False)
        some = np.flatnonzero(close.any(1))
        if not len(some):
            return []
        rid = rows.column("rid").to_numpy()
        links = (close.astype(np.int64) @ rows.column("copies").to_numpy())[some] if counted else np.zeros(len(some), np.int64)
        root = np.full(len(some), rows.column("root")[0].as_py())
        return [np.stack([root, rid[some], rid[_forest(close)[some]], links])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, [], []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("root", "i", "j")])
            edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                key = tuple(keys[:, a].tolist())
                if key != now and held:
                    out += compared(held)
                    held = []
                now = key
                held.append(batch.slice(a, b - a))
            if sum(x.shape[1] for x in out) > 5000:
                yield _edges(out)
                out = []
        if held:
            out += compared(held)
        if out:
            yield _edges(out)

    return run


def _edges(found: list[np.ndarray]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x) for x in np.concatenate(found, 1)], ["root", "a", "b", "links"])


def _by_sketch(limit: int) -> Callable[[pa.Table], np.ndarray]:
    def pick(rows: pa.Table) -> np.ndarray:
        far = np.zeros((rows.num_rows, rows.num_rows), np.uint8)
        for c in ("s1", "s2"):
            s = rows.column(c).to_numpy().view(np.uint64)
            far += np.bitwise_count(s[:, None] ^ s[None, :])
        return far <= limit

    return pick


def _by_cosine(threshold: float) -> Callable[[pa.Table], np.ndarray]:
    def pick(rows: pa.Table) -> np.ndarray:
        column, close = rows.column("vector").combine_chunks(), np.zeros((rows.num_rows, rows.num_rows), bool)
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        groups = [(at, unit(x)) for at, x in _matrices(column)]
        for at, x in groups:
            for other, y in groups:
                if x.shape[1] == y.shape[1]:
                    close[np.ix_(at, other)] = x @ y.T >= threshold
        return close

    return pick


def _beside_pivot(least: float, keep: tuple[str, ...]):
    """The columns ``keep``, and whether each vector has a cosine below ``least`` with its pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = np.ones(batch.num_rows, bool)
            for at, x in _matrices(batch.column("vector")):
                pivots = batch.column("pivot").take(pa.array(at))
                for same, p in _matrices(pivots):
                    if p.shape[1] == x.shape[1]:
                        far[at[same]] = (unit(x[same]) * unit(p)).sum(1) < least
            yield pa.record_batch([*(batch.column(c) for c in keep), pa.array(far)], [*keep, "far"])

    return run


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows (root, far, ...) to the tasks that compare each far one with all of its root, block by block; the others are not compared among themselves."""
    blocks = lambda condition: F.ceil(F.count_if(condition) / BLOCK).cast("int")
    sizes = rows.groupBy("root").agg(blocks(~F.col("far")).alias("near_blocks"), blocks(F.col("far")).alias("far_blocks")).where("far_blocks > 0")
    block = "if(far, near_blocks + pmod(xxhash64(rid), far_blocks), pmod(xxhash64(rid), near_blocks))"
    dealt = rows.join(sizes, "root").withColumn("block", F.expr(block).cast("int"))
    other = F.explode(F.sequence(F.when(F.col("far"), 0).otherwise(F.col("near_blocks")), F.expr("near_blocks + far_blocks - 1")))
    dealt = dealt.withColumn("other", other).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    return dealt.drop("far", "near_blocks", "far_blocks", "other").repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")


def _hex(*of: Column) -> Column:
    return F.lpad(F.hex(F.xxhash64(*of)), 16, "0")


def near_duplicates(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row.

    Two vectors are linked if their cosine in double precision is ``threshold`` or more; a component is what links connect, named by its least id. ``n_links`` counts
    the other rows linked directly, copies among them; ``kept`` marks the row whose id names its component. A null vector, one of length
    zero or with a null, an infinite number or NaN, or of zeros alone, links with nothing, nor do vectors of different lengths. A component without
    any id has a null name, and is not kept. Repeated rows are rows of their own. An empty table gives no rows.

    Equal vectors are hashed once. Distinct ones lie in some buckets of each table (see ``plan``, ``buckets_of``); in a bucket each is compared with the
    first, and those not linked to it with all, block by block: by sketches of sign bits, and by their cosine where these are near. What links connect is a
    group. In a group, vectors within half the threshold's angle of its first vector are linked to each other, by the triangle inequality; any other is compared with
    all of the group, block by block. So every link inside a group is counted exactly, and a link is lost only if no chain of linked pairs that
    met in a bucket joins its ends; a task holds two blocks whatever the size of a bucket or group, and no pairs leave it.
    """
    spark = rows.sparkSession
    vector = F.col(vector_col)
    good = (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf))) & F.exists(vector, lambda x: x != 0)
    marked = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.when(F.coalesce(good, F.lit(False)), vector).alias("vector"))
    key = F.when(F.col("vector").isNotNull(), F.unhex(F.concat(_hex(F.col("vector")), _hex(F.lit(7), F.col("vector")))))
    marked = marked.withColumn("key", key)
    distinct = marked.where("vector is not null").groupBy("key").agg(F.first("vector").alias("vector"), F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
    vectors = written(distinct.withColumn("rid", F.monotonically_increasing_id()), "vectors")

    hashed = map_batches(vectors.select("rid", "vector"), _hasher(vectors.count(), threshold, recall), "rid long, s1 long, s2 long, buckets array<long>")
    hashed = written(hashed, "hashes")
    entries = hashed.select("rid", F.explode("buckets").alias("root"))
    buckets = entries.groupBy("root").agg(F.count("*").alias("size"), F.min("rid").alias("first"), F.bit_xor(F.xxhash64("rid")).alias("members")).where("size > 1")
    buckets = buckets.groupBy("size", "members", "first").agg(F.min("root").alias("root"))  # of buckets with the same vectors, one
    firsts = hashed.select(F.col("rid").alias("first"), F.col("s1").alias("f1"), F.col("s2").alias("f2"))
    sketched = hashed.select("rid", "s1", "s2", F.explode("buckets").alias("root")).join(buckets.join(firsts, "first"), "root")
    limit = sketch_limit(threshold)
    apart = F.bit_count(F.col("s1").bitwiseXOR(F.col("f1"))) + F.bit_count(F.col("s2").bitwiseXOR(F.col("f2")))
    met = written(sketched.select("root", "size", "first", "rid", "s1", "s2", (apart > limit).alias("apart")), "met")
    pairs = met.where("not apart and rid <> first").select("rid", "first").distinct()
    pivots = vectors.select(F.col("rid").alias("first"), F.col("vector").alias("pivot"))
    pairs = pairs.join(vectors.select("rid", "vector"), "rid").join(pivots, "first").select("rid", "first", "vector", "pivot")
    judged = written(map_batches(pairs, _beside_pivot(threshold, ("rid", "first")), "rid long, first long, far boolean"), "pairs")
    stars = judged.where("not far").select(F.col("rid").alias("a"), F.col("first").alias("b"))
    # two vectors alone in a bucket have been compared
    rest = met.where("size > 2").join(judged, ["rid", "first"], "left").withColumn("far", F.coalesce("far", F.col("rid") != F.col("first")))
    rest = rest.select("root", "rid", "far", "s1", "s2")
    edges = "root long, a long, b long, links long"
    near = map_batches(_dealt(rest), _tasks(_by_sketch(limit), False), edges).select("root", F.col("a").alias("rid")).distinct()
    near = written(rest.select("root", "rid", "far").join(near, ["root", "rid"]), "near")
    linked = map_batches(_dealt(near.join(vectors.select("rid", "vector"), "rid")), _tasks(_by_cosine(threshold), False), edges)
    groups = components(stars.union(linked.select("a", "b").distinct()))

    members = groups.select(F.col("node").alias("rid"), "root").join(vectors.select("rid", "vector", "copies"), "rid")
    half = math.cos(math.acos(threshold) / 2 - 1e-7)
    beside = T.StructType([T.StructField(c, T.LongType()) for c in ("root", "rid", "copies")] + [vectors.schema["vector"], T.StructField("far", T.BooleanType())])
    members = members.join(pivots.withColumnRenamed("first", "root"), "root").select("root", "rid", "copies", "vector", "pivot")
    placed = written(map_batches(members, _beside_pivot(half, ("root", "rid", "copies", "vector")), beside), "groups")
    crossing = written(map_batches(_dealt(placed), _tasks(_by_cosine(threshold), True), edges), "links")

    close = placed.where("not far").select("root", "rid", "copies")
    together = close.groupBy("root").agg(F.sum("copies").alias("all"))
    counted = close.join(together, "root").select("rid", (F.col("all") - F.col("copies")).alias("links")).union(crossing.select(F.col("a").alias("rid"), "links"))
    links = counted.groupBy("rid").agg(F.sum("links").alias("links"))
    grouped = groups.select(F.col("node").alias("rid"), "root")
    classed = vectors.select("rid", "key", "least_id", "copies").join(links, "rid", "left").join(grouped, "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    names = classed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classed = classed.join(names, "root").select("key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    spread = marked.select("vec_id", "key").join(classed, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return spread.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
