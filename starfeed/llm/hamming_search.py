"""Exact k nearest binary codes by incremental multi-index hashing."""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, functions as F, types as T

from starfeed.workspace import written

BITS = 64
K = 10
SALTS = 16
#: Ids in a block of codes (some 100 bytes each in the task that searches it), and codes that a task is asked for.
BLOCK, GROUP = 1 << 21, 1 << 18
#: Buckets and candidates looked at in one go.
AT_ONCE, CANDIDATES = 1 << 20, 1 << 18
FOUND = "asked long, near array<struct<distance:int,id:long>>"


def sign_code(embedding: str) -> Column:
    """The signs of the first 64 numbers of a vector as the bits of a long: 1 for a positive one.
    Missing and null numbers count as not positive; a null vector has a null code."""
    value = lambda i: F.coalesce(F.get(F.col(embedding), F.lit(i)), F.lit(0.0)) > 0
    halves = []
    for low in (0, BITS // 2):
        bits = [F.when(value(i), F.lit(1 << (i - low))).otherwise(F.lit(0)).cast("long") for i in range(low, low + BITS // 2)]
        total = bits[0]
        for b in bits[1:]:
            total = total.bitwiseOR(b)
        halves.append(total)
    code = halves[0].bitwiseOR(F.shiftleft(halves[1], BITS // 2))
    return F.when(F.col(embedding).isNotNull(), code)


def _segments(distinct: int) -> list[tuple[int, int]]:
    """(shift, width) of the segments. About log2(n) bits each, so that a bucket holds about one code."""
    count = math.ceil(BITS / max(2, round(math.log2(max(distinct, 2)))))
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


@lru_cache(64)
def _masks(width: int, radius: int) -> np.ndarray:
    return np.asarray([sum(1 << b for b in bits) for bits in combinations(range(width), radius)], np.uint64)


def _first_ids(rows: DataFrame, k: int) -> DataFrame:
    """(code, ids): the k + 1 least ids of each code. Rows of one code are first cut down in salted parts."""
    salted = rows.select("code", "id").distinct().select("code", "id", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"))
    ranked = salted.withColumn("n", F.expr("row_number() over (partition by code, salt order by id)")).where(F.col("n") <= k + 1)
    ranked = ranked.withColumn("n", F.expr("row_number() over (partition by code order by id)")).where(F.col("n") <= k + 1)
    return ranked.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids"))


class Block:
    """Codes, each with its ids in order (``starts`` cuts ``ids``), and their buckets by segment."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, ids: np.ndarray):
        self.codes, self.starts, self.ids = codes.astype(np.int64).view(np.uint64), starts, ids
        self.sizes, self.first = np.diff(starts), ids[starts[:-1]]
        self.segments = _segments(len(codes))
        # a bucket begins in a new row of the table, so that a row is read at once; the rest of its last row is filled up
        wide = 1 << min(3, max(0, math.floor(math.log2(max(1, len(codes) / 2 ** self.segments[0][1])))))
        self.tables = []
        for j, (_, width) in enumerate(self.segments):
            value = self._value(self.codes, j).astype(np.int64)
            order = np.argsort(value, kind="stable").astype(np.int32)
            n = np.bincount(value, minlength=1 << width)
            rows = -(-n // wide)
            edges = np.concatenate([[0], np.cumsum(rows)]).astype(np.int32)
            at = np.arange(len(codes)) + np.repeat(edges[:-1].astype(np.int64) * wide - np.cumsum(n) + n, n)
            place = np.full(edges[-1] * wide, -1, np.int32)
            place[at] = order
            table = np.zeros(len(place), np.uint64)
            table[at] = self.codes[order]
            self.tables.append((edges, table.reshape(-1, wide), place))

    def _value(self, codes: np.ndarray, j: int) -> np.ndarray:
        shift, width = self.segments[j]
        return (codes >> np.uint64(shift)) & np.uint64((1 << width) - 1)

    def _seen(self, differ: np.ndarray, radius: int, j: int) -> np.ndarray:
        """Whether an earlier step than segment ``j`` at ``radius`` has met the code, by the bits in which it differs."""
        seen = np.zeros(len(differ), bool)
        for i in range(len(self.segments)):
            seen |= np.bitwise_count(self._value(differ, i)) < radius + (i < j)
        return seen

    def search(self, asked: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of ``asked``, distance, id) of the ``most`` nearest ids to each, by distance and id; row by row.

        Looks segment by segment into the buckets within r bits of the asked code's own, from r = 0 on. Two codes at distance up to
        m * r + j agree up to r bits in one of the first j + 1 of m segments or up to r - 1 bits in another one, so once the last of the nearest found is
        not above that, the code is done. Where buckets and their codes come to more than the block has codes, these are looked at one by one instead.
        """
        asked = asked.astype(np.int64).view(np.uint64)
        state = _Nearest(self, asked, most)
        open_ = np.arange(len(asked))
        for radius in range(max(w for _, w in self.segments) + 1):
            for j, (_, width) in enumerate(self.segments):
                if not len(open_):
                    return state.ids()
                if math.comb(width, radius) > len(self.codes):
                    self._scan(state, open_, radius, j)
                    return state.ids()
                much = self._probe(state, open_, _masks(width, radius), radius, j)
                if len(much):
                    self._scan(state, much, radius, j)
                    open_ = np.setdiff1d(open_, much, assume_unique=True)
                open_ = open_[state.worst[open_] > len(self.segments) * radius + j]
        return state.ids()

    def _probe(self, state: _Nearest, rows: np.ndarray, masks: np.ndarray, radius: int, j: int) -> np.ndarray:
        """Looks into the buckets, for all rows mask by mask, in the buckets' order; returns the rows for which they hold too much."""
        edges, table, place = self.tables[j]
        wide = table.shape[1]
        own = self._value(state.asked[rows], j)
        sort = np.argsort(own, kind="stable")
        rows, own, total = rows[sort], own[sort], np.full(len(rows), len(masks))
        step, much = max(1, AT_ONCE // len(rows)), [rows[:0]]
        for at in range(0, len(masks), step):
            value = (masks[at : at + step, None] ^ own[None, :]).view(np.int64)
            low = edges[value]
            n = edges[value + 1] - low
            total += n.sum(0) * wide
            over = total > len(self.codes)
            if over.any():
                much.append(rows[over])
                rows, own, total, low, n = rows[~over], own[~over], total[~over], low[:, ~over], n[:, ~over]
                if not len(rows):
                    break
            full = np.flatnonzero(n)
            part, begin, row = n.ravel()[full], low.ravel()[full], rows[full % len(rows)]
            done = np.cumsum(part, dtype=np.int64)
            several = CANDIDATES // wide
            cuts = np.searchsorted(done, np.arange(several, (done[-1] if len(done) else 0) + several, several)) + 1
            for a, b in zip([0, *cuts], cuts):
                some = part[a:b]
                at_row = np.repeat(begin[a:b] - np.cumsum(some) + some, some) + np.arange(some.sum())
                state.meet(np.repeat(row[a:b], some), table.take(at_row, 0), at_row * wide, place, radius, j)
        return np.concatenate(much)

    def _scan(self, state: _Nearest, rows: np.ndarray, radius: int, j: int) -> None:
        place = np.arange(len(self.codes), dtype=np.int32)
        for a in range(0, len(rows), 16):
            some = rows[a : a + 16]
            for at in range(0, len(self.codes), CANDIDATES // 16):
                state.meet(some, self.codes[None, at : at + CANDIDATES // 16], np.full(len(some), at), place, radius, j)


class _Nearest:
    """Of each asked code the nearest codes so far, by distance and least id: at most ``most``, as each has an id."""

    def __init__(self, block: Block, asked: np.ndarray, most: int):
        self.block, self.asked, self.most = block, asked, min(most, len(block.codes))
        self.wanted = most
        self.distance = np.full((len(asked), self.most), BITS + 1, np.uint8)
        self.index = np.zeros((len(asked), self.most), np.int32)
        self.worst = np.full(len(asked), BITS + 1, np.uint8)  # that of the last id wanted, if there are as many

    def meet(self, row: np.ndarray, codes: np.ndarray, low: np.ndarray, place: np.ndarray, radius: int, j: int) -> None:
        """Takes in what segment ``j`` at ``radius``, or a scan in its place, brings: for each row some codes, which lie in a table from ``low`` on.
        ``place`` has the places of the table's codes in the block, -1 where there is none."""
        differ = codes ^ self.asked[row][:, None]
        distance = np.bitwise_count(differ)
        near = np.flatnonzero(distance <= self.worst[row][:, None])
        of, at = np.divmod(near, differ.shape[1])
        index = place[low[of] + at]
        new = (index >= 0) & ~self.block._seen(differ.ravel()[near], radius, j)
        if not new.any():
            return
        row, distance, index = row[of[new]], distance.ravel()[near[new]], index[new]
        touched, number = np.unique(row, return_inverse=True)
        before = self.distance[touched] <= BITS
        number = np.concatenate([np.nonzero(before)[0], number])
        distance = np.concatenate([self.distance[touched][before], distance])
        index = np.concatenate([self.index[touched][before], index])
        order = np.lexsort((self.block.first[index], distance, number))
        number, distance, index = number[order], distance[order], index[order]
        begin = np.searchsorted(number, np.arange(len(touched)))
        ids = np.cumsum(self.block.sizes[index])
        before = ids - self.block.sizes[index]
        before -= before[begin][number]
        last = np.flatnonzero((before < self.wanted) & (before + self.block.sizes[index] >= self.wanted))
        self.worst[touched[number[last]]] = distance[last]
        rank = np.arange(len(number)) - begin[number]
        kept = rank < self.most
        number, rank = number[kept], rank[kept]
        self.distance[touched[number], rank], self.index[touched[number], rank] = distance[kept], index[kept]

    def ids(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, place = np.nonzero(self.distance <= self.worst[:, None])
        found = self.distance[row, place] <= BITS
        row, place = row[found], place[found]
        index, distance = self.index[row, place], self.distance[row, place]
        n = self.block.sizes[index]
        at = np.repeat(self.block.starts[index] - np.cumsum(n) + n, n) + np.arange(n.sum())
        row, distance, ids = np.repeat(row, n), np.repeat(distance, n), self.block.ids[at]
        order = np.lexsort((ids, distance, row))
        row, distance, ids = row[order], distance[order], ids[order]
        kept = np.arange(len(row)) - np.searchsorted(row, row) < self.wanted
        return row[kept], distance[kept].astype(np.int32), ids[kept]


def _found(codes: pa.Table, asked: pa.Table, most: int) -> pa.Table:
    lists = codes.column("ids").combine_chunks()
    wanted = np.sort(asked.column("asked").to_numpy())
    if len(lists) and len(wanted):
        starts = lists.offsets.to_numpy().astype(np.int64)
        row, distance, ids = Block(codes.column("code").to_numpy(), starts - starts[0], lists.flatten().to_numpy()).search(wanted, most)
    else:
        row, distance, ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)
    offsets = pa.array(np.searchsorted(row, np.arange(len(wanted) + 1)), pa.int32())
    pairs = pa.StructArray.from_arrays([pa.array(distance, pa.int32()), pa.array(ids, pa.int64())], ["distance", "id"])
    return pa.table([pa.array(wanted, pa.int64()), pa.ListArray.from_arrays(offsets, pairs)], ["asked", "near"])


def top_k(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(id, code, neighbours) for each row of ``queries``: its k nearest rows of ``rows`` by Hamming
    distance, itself not among them, as an array of (distance, id) in that order; ties go to the least id.

    Both have id (long) and code (long). Rows without a code or an id are not found, and a query without a code has no neighbours.
    Repeated rows are found once; the neighbours of an id exclude all rows of that id.

    Equal codes are searched for and found once, so a code that a third of the rows share is one entry. The codes are dealt into blocks by their hash, and
    those asked for into groups. A task has a block and a group, indexes the block by segments and searches it (``Block.search``); of each
    asked code and block no more than the nearest ids leave the task. So what is moved grows with the codes times the
    groups and the asked codes times the blocks, not with the candidates. The result is exact.
    """
    spark = rows.sparkSession
    # an id's own rows are dropped at the end: one, unless it has several codes
    own = queries.where("code is not null and id is not null").distinct().groupBy("id").count().agg(F.max("count")).first()[0] or 0
    if own > 1:
        own = rows.where("code is not null").join(queries.select("id").distinct(), "id", "left_semi").distinct().groupBy("id").count().agg(F.max("count")).first()[0] or 0
    most = k + max(own, 1)
    codes = written(_first_ids(rows.where("code is not null and id is not null"), most - 1), "codes")
    asked = written(queries.where("code is not null").select(F.col("code").alias("asked")).distinct(), "asked")
    blocks = max(1, math.ceil((codes.agg(F.sum(F.size("ids"))).first()[0] or 0) / BLOCK))
    many = asked.count()
    groups = max(1, math.ceil(many / GROUP), min(math.ceil(2 * spark.sparkContext.defaultParallelism / blocks), many // 256))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    left = codes.select(dealt("code", blocks).alias("block"), each(groups).alias("group"), "code", "ids")
    right = asked.select(each(blocks).alias("block"), dealt("asked", groups).alias("group"), "asked")
    tasks = 4 * blocks * groups  # a hash deals the pairs out, seldom two to a task
    left, right = (x.repartition(tasks, "block", "group").groupBy("block", "group") for x in (left, right))
    found = left.cogroup(right).applyInArrow(lambda a, b: _found(a, b, most), FOUND)
    found = written(found, "found")
    lists = found.groupBy(F.col("asked").alias("code")).agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, most).alias("near"))
    rows = queries.join(lists, "code", "left")
    others = F.filter("near", lambda x: ~x["id"].eqNullSafe(F.col("id")))
    empty = F.array().cast(T.ArrayType(T.StructType([T.StructField("distance", T.IntegerType()), T.StructField("id", T.LongType())])))
    return rows.select("id", "code", F.coalesce(F.slice(others, 1, k), empty).alias("neighbours"))
