"""A hierarchical Pitman-Yor language model: Chinese-restaurant seating sampled by Gibbs, over all documents.

A token's context is the word before it, or the text's start. Each context is a restaurant whose customers are its tokens
and whose dishes are words; there are as many as the corpus has words. All of them share one parent restaurant, whose customers are their tables, and
whose base is uniform over the known words and one unknown word.

The pairs of a word and its context are dealt into cells of a grid, rows by the word's hash and columns by the context's: no word and no context, however
frequent, is all in one cell. Given the totals of the restaurants and the words' numbers in the parent, the seating of one pair depends on no other. Each pass seats
the pairs cell by cell, adds up words and contexts in parts of their own, and delivers to each cell the sums of the words and contexts that it has. Nothing is kept
on the driver but the parent's totals. Names and numbers travel as packed arrays, a row for each cell and chunk of text.
"""

from __future__ import annotations

import ctypes
import math
import pickle
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from starfeed.llm.text import chunks, mixed, most_frequent
from starfeed.workspace import removed, work_dir, written

MARKERS = 32  # contexts that a model shows first
#: Words whose counts are sent to each task for the base score; those of the others are found in the cells.
SENT_WORDS = 1 << 17
DISCOUNT, STRENGTH = 0.8, 1.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.7, 1.0
BURN_IN, SAMPLES = 1, 3  # passes before the last, and seatings averaged in that one
#: Up to so many customers tables are drawn from their exact distribution, else by so many Metropolis steps: fewer for many tables, which vary little about the mean they begin at.
EXACT, PROPOSALS, FEW_PROPOSALS = 512, 16, 4
CHUNK = 6_000_000
KEPT_HASHES, WORDS_AT_ONCE = 300_000, 200_000  # what a task holds of words themselves: the rest of a chunk is 8 bytes a token
SHIFT = 40  # a context and a count in one long: context << SHIFT | count
SEED = 11
STATE, WORDS, CONTEXTS, ALL_WORDS, TOKENS = range(5)
ROW = "kind int, part long, cell int, data binary"


class Hashes(dict):
    """word in bytes -> 64-bit hash as a signed number; the end of a text is the empty word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_HASHES:
            self.clear()
        value = self[word] = (xxhash.xxh3_64_intdigest(word) ^ 0x8000000000000000) - 0x8000000000000000
        return value


def held_out(doc_id: int | None) -> bool:
    """Whether the document is kept from training. A null id is the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    # in UTF-8, bytes.split() cuts at just the six characters that the contract names and lower() takes A-Z only
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))


def _tokens(batch: pa.RecordBatch, hashes: Hashes, training_only: bool) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Hashes of all tokens, where the text of each begins, and the indices of the rows taken."""
    words, counts, rows, done = [], [], [], []
    for i, (doc_id, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())):
        if training_only and held_out(doc_id):
            continue
        found = text.lower().split()
        words += found
        words.append(b"")
        counts.append(len(found) + 1)
        rows.append(i)
        if len(words) >= WORDS_AT_ONCE:
            done.append(np.fromiter(map(hashes.__getitem__, words), np.int64, len(words)))
            words = []
    counts = np.asarray(counts, np.int64)
    starts = np.repeat(np.cumsum(counts) - counts, counts)
    done.append(np.fromiter(map(hashes.__getitem__, words), np.int64, len(words)))
    return np.concatenate(done), starts, rows


START = Hashes()[b" "]  # no word has a blank


def _release() -> None:
    """Gives back what earlier work of this process has freed: a worker lives through many tasks, and the C library would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


def _packed(*arrays: np.ndarray) -> bytes:
    """Whole numbers that are not negative take as few bytes as the largest of them, others four."""

    def small(x: np.ndarray) -> np.ndarray:
        if x.dtype.kind == "f":
            whole = x.astype(np.int64)
            if (whole != x).any():
                return x.astype(np.float32)
            x = whole
        return x.astype(np.min_scalar_type(x.max())) if len(x) and x.min() >= 0 else x

    return pickle.dumps([small(x) for x in arrays], protocol=5)


def _each(table: pa.Table | pa.RecordBatch) -> Iterator[dict]:
    """Rows of ``ROW``, ``data`` unpacked, in an order that does not depend on the shuffle's."""
    about, data = table.select(["kind", "part", "cell"]).to_pylist(), table.column("data")
    for i in sorted(range(len(about)), key=lambda i: tuple(about[i].values())):
        yield about[i] | {"data": pickle.loads(data[i].as_buffer())}


def _rows(table: pa.Table | pa.RecordBatch) -> list[dict]:
    return list(_each(table))


def _table(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary()]
    return pa.table([pa.array(x, k) for x, k in zip(zip(*rows) if rows else [[]] * 4, kinds)], [x.split()[0] for x in ROW.split(", ")])


@dataclass
class Grid:
    """``across`` times ``down`` cells. A word's sums lie in a part of its row, a context's in a part of its column."""

    down: int
    across: int

    @staticmethod
    def of(parts: int) -> Grid:
        down = max(1, math.isqrt(parts))
        return Grid(down, max(1, parts // down))

    def word(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = mixed(w.view(np.uint64))
        row = x % np.uint64(self.down)
        return row.astype(np.int64), (row * np.uint64(self.across) + x // np.uint64(self.down) % np.uint64(self.across)).astype(np.int64)

    def context(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = mixed(u.view(np.uint64))
        column = x % np.uint64(self.across)
        return column.astype(np.int64), (column * np.uint64(self.down) + x // np.uint64(self.across) % np.uint64(self.down)).astype(np.int64)


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when what needed them is written, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _kept(df: DataFrame, label: str) -> DataFrame:
    with _shuffles_dropped(df.sparkSession):
        return written(df, label)


def _dropped(*tables: DataFrame | None) -> None:
    """Deletes what passes before the last have written."""
    for df in tables:
        if df is not None:
            removed(df.sparkSession, {f.rpartition("/")[0] for f in df.inputFiles()})


def _in_buckets(df: DataFrame, buckets: int, label: str) -> DataFrame:
    """Written and read back as ``written`` does, but known to be dealt by cell, so that it is not shuffled where cells meet."""
    name, path = f"{label.replace('-', '_')}_{uuid.uuid4().hex}", work_dir(df.sparkSession, label)
    with _shuffles_dropped(df.sparkSession):
        df.write.bucketBy(buckets, "cell").format("parquet").option("path", path).saveAsTable(name)
    table = df.sparkSession.table(name)
    df.sparkSession.sql(f"drop table {name}")  # the name alone: the files stay
    return table


def _cut(batch: pa.RecordBatch, hashes: Hashes, grid: Grid):
    """Of a chunk: names of words and of contexts, and cell by cell the pairs in the order of the names and, of each token, pair and row."""
    tokens, starts, _ = _tokens(batch, hashes, False)
    begins = starts == np.arange(len(starts))
    del starts
    names, number = np.unique(tokens, return_inverse=True)
    del tokens
    contexts, number = np.append(names, START), number.astype(np.int32)
    before = np.concatenate([[len(names)], number[:-1]]).astype(np.int32)
    before[begins] = len(names)
    key = number.astype(np.int64) * len(contexts) + before
    del number, before
    order = np.argsort(key)
    key, row = key[order], (np.cumsum(begins, dtype=np.int32) - 1)[order]
    del order
    first = np.flatnonzero(np.diff(key, prepend=-1))
    size = np.diff(np.append(first, len(key))).astype(np.int32)
    key = key[first]
    w = (key // len(contexts)).astype(np.int32)
    u = (key - w.astype(np.int64) * len(contexts)).astype(np.int32)
    cell = (grid.word(names)[0] * grid.across).astype(np.int32)[w] + grid.context(contexts)[0].astype(np.int32)[u]
    return names, contexts, w, u, cell, first, size, row


def _by_cell(cell: np.ndarray, cells: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(cell.astype(np.min_scalar_type(cells)), kind="stable")
    edges = np.searchsorted(cell[order], np.arange(cells + 1))
    for k in range(cells):
        if edges[k] < edges[k + 1]:
            yield k, order[edges[k] : edges[k + 1]]


def _runs(names: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The names that an ascending index has, and how often."""
    first = np.flatnonzero(np.diff(index, prepend=-1))
    return names[index[first]], np.diff(np.append(first, len(index)))


def _named(names: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The names that occur, in their order, and the indices into these."""
    there = np.zeros(len(names), bool)
    there[index] = True
    return names[there], (np.cumsum(there) - 1)[index]


def count_pairs(source: DataFrame, grid: Grid, buckets: int) -> DataFrame:
    """For each cell its words and contexts in order, and of each pair the two and how often training texts have it: 0 if only held-out ones do."""
    cells = grid.down * grid.across

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in chunks(batches, "text", CHUNK):
            if not batch.num_rows:
                continue
            _release()
            names, contexts, w, u, cell, first, size, row = _cut(batch, hashes, grid)
            train = ~np.asarray([held_out(x) for x in batch.column("doc_id").to_pylist()])
            n = np.add.reduceat(train[row].astype(np.int64), first)
            out = []
            for k, at in _by_cell(cell, cells):
                words, runs = _runs(names, w[at])
                befores, ui = _named(contexts, u[at])
                out.append((TOKENS, 0, k, _packed(words, runs, befores, ui, n[at])))
            yield from _table(out).to_batches()

    def merge(table: pa.Table) -> pa.Table:
        _release()
        rows = _rows(table)
        words, w = np.unique(np.concatenate([r["data"][0] for r in rows]), return_inverse=True)
        contexts, u = np.unique(np.concatenate([r["data"][2] for r in rows]), return_inverse=True)
        key, at, to = [], 0, 0
        for r in rows:
            names, sizes, befores, ui, _ = r["data"]
            key.append(np.repeat(w[at : at + len(names)], sizes) * len(contexts) + u[to : to + len(befores)][ui])
            at, to = at + len(names), to + len(befores)
        key, n = np.concatenate(key), np.concatenate([r["data"][4] for r in rows]).astype(np.int64)
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        n = np.add.reduceat(n[order], first)
        wi, ui = np.divmod(key[first], len(contexts))
        return _table([(STATE, 0, rows[0]["cell"], _packed(words, np.bincount(wi, minlength=len(words)), contexts, ui, n))])

    counted = source.mapInArrow(run, ROW).repartition(buckets, "cell").groupBy("cell").applyInArrow(merge, ROW)
    return _in_buckets(counted, buckets, "pair-counts")


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x > 0: six steps up, then Stirling's series."""
    shift = np.log(x * (x + 1)) + np.log((x + 2) * (x + 3)) + np.log((x + 4) * (x + 5))
    y = x + 6
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) - shift


def seat(n: np.ndarray, a: np.ndarray, gain: np.ndarray, d: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Seats n[i] customers who all eat one dish, one after the other: with t tables and k customers seated the next one
    opens a table with probability A / (k - d t + A), where A = a + gain t is the weight of a new table. Returns
    the tables and the log of the product of the weights' sums (up to a constant).

    Goes from table to table: the distance to the next is drawn by the present probability and, as that falls
    with each customer, accepted with the ratio of the later to the present one. So a block costs its tables, not its customers.
    """
    t, weight = np.ones(len(n), np.int64), np.zeros(len(n))
    live = np.flatnonzero(n > 1)
    k = np.ones(len(live), np.int64)
    while len(live):
        tables = t[live]
        new = a[live] + gain[live] * tables
        base = new - d * tables
        q = new / (k + base)
        with np.errstate(divide="ignore"):
            step = np.floor(np.log(rng.random(len(live))) / np.log1p(-np.minimum(q, 1 - 1e-12)))
        at = k + np.minimum(step, 1e15).astype(np.int64)  # customers seated when the next one may open a table
        end = at >= n[live]
        until = np.where(end, n[live], at + 1)
        weight[live] += log_gamma(until + base) - log_gamma(k + base)
        opens = ~end & (rng.random(len(live)) < (k + base) / (at + base))
        t[live[opens]] += 1
        live, k = live[~end], until[~end]
        over = k >= n[live]
        live, k = live[~over], k[~over]
    return t, weight


def stirling(most: int, d: float) -> np.ndarray:
    """log S[n, t]: of the ways in which n customers may sit at t tables, the weights that do not depend on who opens a table."""
    s = np.full((most + 1, most + 1), -np.inf)
    s[1, 1] = 0
    for n in range(1, most):
        t = np.arange(1, n + 1)
        s[n + 1, 1 : n + 1] = np.logaddexp(s[n, :n], s[n, 1 : n + 1] + np.log(n - d * t))
        s[n + 1, n + 1] = 0
    return s


def leaps(n: np.ndarray, strength: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """The tables of n[i] customers in a restaurant of one dish and no base: customers come one by one up to 64, then in groups of a 64th of those there,
    each with the chance of the middle one."""
    t, k, live = np.ones(len(n), np.int64), 1, np.flatnonzero(n > 1)
    while len(live):
        step = np.minimum(max(1, k // 64), n[live] - k)
        t[live] += rng.binomial(step, (strength[live] + d * t[live]) / (strength[live] + k + (step - 1) / 2))
        k += max(1, k // 64)
        live = live[n[live] > k]
    return t


def tables(n: np.ndarray, a: np.ndarray, gain: np.ndarray, d: float, rng: np.random.Generator, log_s: np.ndarray, samples: int = 1) -> np.ndarray:
    """The mean of ``samples`` draws of the tables of n[i] > 0 customers who all eat one dish, all else given: t tables have a weight of
    S(n, t) times a (a + gain) ... (a + (t - 1) gain). Up to ``EXACT`` customers they are drawn from just these weights; beyond, ``seat`` or ``leaps`` proposes, for all
    draws in one go, the tables of a plain restaurant of another strength, and Metropolis steps accept."""
    t = np.ones(len(n))
    few = np.flatnonzero((n > 1) & (n <= EXACT))
    few = few[np.argsort(n[few], kind="stable")]
    edges = np.searchsorted(n[few], np.arange(2, EXACT + 2))
    for k, (low, high) in enumerate(zip(edges, edges[1:]), 2):
        for at in range(low, high, 1 + 200_000 // k):
            some = few[at : min(at + 1 + 200_000 // k, high)]
            weight = np.cumsum(np.log(a[some, None] + gain[some, None] * np.arange(k)), 1) + log_s[k, 1 : k + 1]
            weight = np.cumsum(np.exp(weight - weight.max(1, keepdims=True)), 1)
            for _ in range(samples):
                t[some] += (rng.random(len(some))[:, None] * weight[:, -1:] > weight[:, :-1]).sum(1) / samples
    many = np.flatnonzero(n > EXACT)
    if len(many):
        n, a, gain = n[many], a[many], gain[many]
        low, high = np.full(len(n), -d), np.maximum(a + gain, d)
        for _ in range(40):  # the strength at which the ratio of the weights to those of the proposal is flat about the proposal's mean
            own = (low + high) / 2
            mean = np.clip((np.exp(log_gamma(own + n + d) - log_gamma(own + n) + log_gamma(own + 1) - log_gamma(own + d)) - own) / d, 1, n)
            above = own > a + gain * mean - d * mean
            low, high = np.where(above, low, own), np.where(above, own, high)
        own = np.maximum(own, -d / 2)  # near -d it proposes one table alone
        ratio = lambda t, i: t * np.log(gain[i] / d) + log_gamma(t + a[i] / gain[i]) - log_gamma(t + own[i] / d)
        now = np.tile(np.rint(mean), (samples, 1))
        for some, steps in ((np.flatnonzero(mean <= 16), PROPOSALS), (np.flatnonzero(mean > 16), FEW_PROPOSALS)):
            times = samples * steps
            x = np.tile(n[some], times), np.tile(own[some], times)
            found = leaps(*x, d, rng) if steps == FEW_PROPOSALS else seat(*x, np.full(len(x[0]), d), d, rng)[0]
            for other in found.reshape(steps, samples, len(some)):
                taken = np.log(rng.random(other.shape)) < ratio(other, some) - ratio(now[:, some], some)
                now[:, some] = np.where(taken, other, now[:, some])
        t[many] = now.mean(0)
    return t


@dataclass
class Parent:
    """Customers and tables of the parent restaurant, and how many words and tokens the training texts have."""

    customers: float
    tables: float
    words: int
    tokens: int

    @property
    def base(self) -> float:
        return 1 / (self.words + 1)

    def probability(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Of words, by their customers and tables there."""
        new = (PARENT_STRENGTH + PARENT_DISCOUNT * self.tables) * self.base
        return (np.maximum(customers - PARENT_DISCOUNT * tables, 0) + new) / (PARENT_STRENGTH + self.customers)


def _sums(cell: int, state: list[np.ndarray], t: np.ndarray, grid: Grid) -> list[tuple[int, int, int, bytes]]:
    """What a cell has of its words and contexts, a row for each of their parts: names, customers, tables."""
    words, sizes, contexts, ui, n = state
    wi, out = np.repeat(np.arange(len(words)), sizes), []
    for kind, names, index, parts in ((WORDS, words, wi, grid.word(words)[1]), (CONTEXTS, contexts, ui, grid.context(contexts)[1])):
        customers, seated = np.bincount(index, n, len(names)).astype(np.int64), np.bincount(index, t, len(names))
        low = parts.min()
        for part, at in _by_cell(parts - low, int(parts.max() - low) + 1):
            out.append((kind, part + int(low), cell, _packed(names[at], customers[at], seated[at])))
    return out


def _totalled(sums: DataFrame, before: Parent | None, turn: int, partitions: int) -> tuple[DataFrame, Parent]:
    """Adds up the cells' sums of each word and context, seats the words in the parent, and delivers to each cell the values of those that it has, in its own order:
    count, customers and tables in the parent of words, customers and tables of contexts. Before the first pass a word has one table in the parent."""
    log_s = stirling(EXACT, PARENT_DISCOUNT)

    def run(table: pa.Table) -> pa.Table:
        _release()
        rows = _rows(table)
        kind, part = rows[0]["kind"], rows[0]["part"]
        names, at = np.unique(np.concatenate([r["data"][0] for r in rows]), return_inverse=True)
        c = np.bincount(at, np.concatenate([r["data"][1] for r in rows])).astype(np.int64)
        t = np.bincount(at, np.concatenate([r["data"][2] for r in rows]))
        values = [c, t]
        if kind == WORDS:
            t0 = (c > 0).astype(float)
            if before is not None:
                rng = np.random.default_rng([SEED, turn, part, 1])
                some = np.flatnonzero(t >= 1)
                a = (PARENT_STRENGTH + PARENT_DISCOUNT * np.full(len(some), max(before.tables - 1, 0.0))) * before.base
                t0[some] = tables(t[some].astype(np.int64), a, np.full(len(some), PARENT_DISCOUNT * before.base), PARENT_DISCOUNT, rng, log_s, SAMPLES)
            values.append(t0)
        out, edge = [], 0
        for r in rows:
            own = at[edge : edge + len(r["data"][0])]
            edge += len(own)
            out.append((kind, part, r["cell"], _packed(*[v[own] for v in values])))
        if kind == WORDS:
            out.append((ALL_WORDS, part, -1, _packed(names, *values)))
        return _table(out)

    totals = sums.repartition(2 * partitions, "kind", "part").groupBy("kind", "part").applyInArrow(run, ROW)
    totals = _kept(totals, "totals")

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [r["data"] for r in _rows(batch)]
            each = [[float(t.sum()), float(t0.sum()), int((c > 0).sum()), int(c.sum())] for _, c, t, t0 in found]
            yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*each) if each else [[]] * 4, [pa.float64()] * 2 + [pa.int64()] * 2)], ["a", "b", "c", "d"])

    x = totals.where(F.col("kind") == ALL_WORDS).mapInArrow(added, "a double, b double, c long, d long").collect()
    x = sorted(map(tuple, x))
    return totals, Parent(*[math.fsum(v) for v in zip(*x)][:2], sum(r[2] for r in x), sum(r[3] for r in x)) if x else Parent(0.0, 0.0, 0, 0)


def _delivered(rows: list[dict], state: list[np.ndarray], grid: Grid) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The values of a cell's words and of its contexts, put together from those of the parts."""
    out = []
    for kind, names, parts in ((WORDS, state[0], grid.word(state[0])[1]), (CONTEXTS, state[2], grid.context(state[2])[1])):
        low = parts.min()
        places = dict(_by_cell(parts - low, int(parts.max() - low) + 1))
        values: list[np.ndarray] = []
        for r in rows:
            if r["kind"] == kind:
                values = values or [np.zeros(len(names)) for _ in r["data"]]
                for v, x in zip(values, r["data"]):
                    v[places[r["part"] - int(low)]] = x
        out.append(values)
    return out[0], out[1]


def _seated(state: DataFrame, seated: DataFrame | None, totals: DataFrame, parent: Parent, grid: Grid, turn: int, samples: int, buckets: int) -> DataFrame:
    """Seats each pair anew, given the totals, ``samples`` times: the mean tables of each cell's pairs of several customers, and its sums."""
    log_s = stirling(EXACT, DISCOUNT)

    def run(own: pa.Table, given: pa.Table) -> pa.Table:
        _release()
        if not own.num_rows:
            return _table([])
        found, rows = _rows(own)[0], _rows(given)
        cell, (_, sizes, _, ui, n) = found["cell"], found["data"]
        some = np.flatnonzero(n > 1)
        old = next((r["data"][0] for r in rows if r["kind"] == STATE), np.ones(len(some))).astype(float)
        (_, c0, t0), (_, all_t) = _delivered(rows, found["data"], grid)
        t = np.minimum(n, 1).astype(float)
        wi, ui, n = np.repeat(np.arange(len(sizes)), sizes)[some], ui[some], n[some].astype(np.int64)
        p = parent.probability(c0[wi] - old, np.minimum(t0[wi], c0[wi] - old))
        a, rng = (STRENGTH + DISCOUNT * np.maximum(all_t[ui] - old, 0)) * p, np.random.default_rng([SEED, turn, cell, 0])
        t[some] = tables(n, a, DISCOUNT * p, DISCOUNT, rng, log_s, samples)
        return _table([(STATE, 0, cell, _packed(t[some])), *_sums(cell, found["data"], t, grid)])

    given = totals.where(F.col("cell") >= 0)
    given = given if seated is None else given.unionByName(seated.where(F.col("kind") == STATE))
    return _kept(state.groupBy("cell").cogroup(given.repartition(buckets, "cell").groupBy("cell")).applyInArrow(run, ROW), "seated")


def _all_tables(n: np.ndarray, several: np.ndarray) -> np.ndarray:
    t = np.minimum(n, 1).astype(float)
    t[n > 1] = several
    return t


@dataclass
class Totals:
    """Customers and tables of each restaurant (the parent last), and the number of known words."""

    customers: np.ndarray
    tables: np.ndarray
    words: int

    def parent(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        return Parent(self.customers[-1], self.tables[-1], self.words, 0).probability(customers, tables)

    def back_off(self) -> np.ndarray:
        return (STRENGTH + DISCOUNT * self.tables[:-1]) / (STRENGTH + self.customers[:-1])


@dataclass
class Model:
    """State, mean tables and totals by cell. ``markers``, ``totals`` and ``words`` put a small model together on the driver, to look into it."""

    state: DataFrame
    seated: DataFrame
    totalled: DataFrame
    parent: Parent
    grid: Grid
    buckets: int

    def counts(self) -> DataFrame:
        """(w, c) of each training word."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in _rows(batch):
                    known = r["data"][1] > 0
                    yield pa.record_batch([pa.array(r["data"][0][known]), pa.array(r["data"][1][known].astype(np.int64))], ["w", "c"])

        return self.totalled.where(F.col("kind") == ALL_WORDS).mapInArrow(run, "w long, c long")

    @cached_property
    def _pairs(self) -> list[tuple[np.ndarray, ...]]:
        """By cell: words, contexts, counts and mean tables of the pairs that training texts have."""
        t = {r["cell"]: r["data"][0] for r in _rows(self.seated.toArrow())}
        out = []
        for r in _rows(self.state.toArrow()):
            words, sizes, contexts, ui, n = r["data"]
            some = n > 0
            out.append((np.repeat(words, sizes)[some], contexts[ui][some], n[some].astype(np.int64), _all_tables(n, t[r["cell"]])[some]))
        return out

    @cached_property
    def _contexts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        u, at = np.unique(np.concatenate([np.full(1, START), *[x[1] for x in self._pairs]]), return_inverse=True)
        n, t = (np.bincount(at, np.concatenate([np.zeros(1), *[x[i] for x in self._pairs]])) for i in (2, 3))
        order = np.lexsort((u, -n, u != START))
        return u[order], n[order], t[order]

    @property
    def markers(self) -> np.ndarray:
        """The most frequent contexts, numbered from 1; those that follow have the numbers above, and 0 is the text's start."""
        return self._contexts[0][1 : MARKERS + 1]

    @property
    def totals(self) -> Totals:
        _, c, t = self._contexts
        return Totals(np.append(c, self.parent.customers), np.append(t, self.parent.tables), self.parent.words)

    @property
    def words(self) -> DataFrame:
        """(w, c, c0, t0, pairs, t) of each training word: its contexts and counts as context << SHIFT | count, and its mean tables in them."""
        rows = _rows(self.totalled.where(F.col("kind") == ALL_WORDS).toArrow())
        known = {w: (int(c), float(c0), float(t0), [], []) for r in rows for w, c, c0, t0 in zip(*r["data"]) if c}
        number = {u: i for i, u in enumerate(self._contexts[0])}
        for pairs in self._pairs:
            for w, u, n, t in zip(*pairs):
                known[w][3].append(number[u] << SHIFT | int(n))
                known[w][4].append(float(t))
        return self.state.sparkSession.createDataFrame([(int(w), *x) for w, x in known.items()], "w long, c long, c0 double, t0 double, pairs array<long>, t array<float>")


def train(source: DataFrame) -> Model:
    """Passes of the sampler, each given the totals of the one before; the last seats several times. Probabilities are linear in the sampled tables, so
    their means give the averaged predictive probabilities. Pairs of held-out texts alone have no customers, and are only told what their word and context have."""
    spark = source.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    grid = Grid.of(buckets)
    state = count_pairs(source, grid, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _rows(batch):
                yield from _table(_sums(r["cell"], r["data"], np.minimum(r["data"][4], 1).astype(float), grid)).to_batches()

    totals, parent = _totalled(state.mapInArrow(run, ROW), None, 0, buckets)
    seated = None
    for turn in range(1, BURN_IN + 2):
        before = seated, totals
        seated = _seated(state, seated, totals, parent, grid, turn, SAMPLES if turn > BURN_IN else 1, buckets)
        _dropped(*before)
        totals, parent = _totalled(seated.where(F.col("kind") != STATE), parent, turn, buckets)
    last = _kept(seated.where(F.col("kind") == STATE), "tables")
    _dropped(seated)
    return Model(state, last, totals, parent, grid, buckets)


@dataclass
class Sent:
    """What each task gets: of the most frequent words sorted hashes and log10 base."""

    keys: np.ndarray
    base: np.ndarray


def _sent(model: Model, most: int) -> Sent:
    top = most_frequent(model.counts(), "c", most).toArrow().combine_chunks()
    w, c = top.column("w").to_numpy(), top.column("c").to_numpy()
    order = np.argsort(w)
    return Sent(w[order], np.log10((c[order] + 1) / (model.parent.tokens + model.parent.words + 1)))


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sent_words: int = SENT_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row.

    ``score`` is the log10 probability of the text's words and its end; 10 to the power of minus score / n_tokens is the
    perplexity. The tokens of a chunk of texts are dealt to the cells of the model, which add up what each text has there; the base of frequent words is added where
    the text is read. A null text is its end alone. Without any training document all words are unknown, with probability one. Repeated rows are counted as
    often as they occur. A text is read by one task; its numbers take some 100 bytes a word there.
    """
    source = _source(docs, id_col, text_col)
    model = train(source)
    grid, parent, cells = model.grid, model.parent, model.grid.down * model.grid.across
    shared = docs.sparkSession.sparkContext.broadcast(_sent(model, sent_words))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sent, chunk = Hashes(), shared.value, TaskContext.get().partitionId() << 33
        for batch in chunks(batches, "text", CHUNK):
            if not batch.num_rows:
                continue
            _release()
            names, contexts, w, u, cell, first, size, row = _cut(batch, hashes, grid)
            place = np.minimum(np.searchsorted(sent.keys, names), max(len(sent.keys) - 1, 0))
            known = sent.keys[place] == names if len(sent.keys) else np.zeros(len(names), bool)
            base = np.where(known, sent.base[place], 0.0) if len(sent.keys) else np.zeros(len(names))
            of = np.repeat(w, size)
            ids = batch.column("doc_id").to_pylist()
            about = [ids, [held_out(x) for x in ids], np.bincount(row, minlength=len(ids)), np.bincount(row, known[of], len(ids)), np.bincount(row, base[of], len(ids))]
            out = []
            for k, at in _by_cell(cell, cells):
                words, runs = _runs(names, w[at])
                befores, ui = _named(contexts, u[at])
                begin = np.cumsum(size[at]) - size[at]
                rows = row[np.repeat(first[at] - begin, size[at]) + np.arange(size[at].sum())]
                data = [words, runs, befores, ui, size[at], rows, known[names.searchsorted(words)].astype(np.uint8)]
                out.append((TOKENS, chunk, k, pickle.dumps([pickle.loads(_packed(*data)), len(ids), about if not out else None], protocol=5)))
            chunk += 1
            yield from _table(out).to_batches()

    def score(own: pa.Table, given: pa.Table) -> pa.Table:
        _release()
        if not own.num_rows:
            return _table([])
        found, tokens = _rows(own)[0], np.asarray(given.column("kind")) == TOKENS
        rows = _rows(given.filter(pa.array(~tokens)))
        words, sizes, contexts, ui, n = found["data"]
        (c, c0, t0), (customers, all_t) = _delivered(rows, found["data"], grid)
        wi = np.repeat(np.arange(len(words)), sizes)
        t = _all_tables(n, next(r["data"][0] for r in rows if r["kind"] == STATE))
        log_p = np.log10((n - DISCOUNT * t + (STRENGTH + DISCOUNT * all_t[ui]) * parent.probability(c0, t0)[wi]) / (STRENGTH + customers[ui]))
        log_base = np.log10((c + 1) / (parent.tokens + parent.words + 1))
        key, out = wi * len(contexts) + ui, []
        del wi, t
        for r in _each(given.filter(pa.array(tokens))):
            (names, runs, befores, bi, size, row, told), texts, about = r["data"]
            w = np.repeat(np.searchsorted(words, names), runs)
            at = np.searchsorted(key, w * len(contexts) + np.searchsorted(contexts, befores)[bi])
            rest = np.where(np.repeat(told, runs), 0.0, 1.0)
            each = [np.bincount(row, np.repeat(x, size), texts) for x in (log_p[at], rest * log_base[w], rest * (c[w] > 0))]
            out.append((TOKENS, r["part"], found["cell"], pickle.dumps([each, about], protocol=5)))
        return _table(out)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def add(table: pa.Table) -> pa.Table:
        found = [r["data"] for r in _rows(table)]
        more, base, known = (sum(each[i] for each, _ in found) for i in range(3))
        ids, held, n, sent_known, sent_base = next(about for _, about in found if about is not None)
        columns = [pa.array(ids, pa.int64()), pa.array(held), pa.array(n), pa.array((sent_known + known).astype(np.int64)), pa.array(np.full(len(ids), parent.tokens)),
                   pa.array(sent_base + base), pa.array(more)]
        return pa.table(columns, [x.split()[0] for x in schema.split(", ")])

    given = model.totalled.where(F.col("cell") >= 0).unionByName(model.seated).unionByName(source.mapInArrow(deal, ROW))
    found = model.state.groupBy("cell").cogroup(given.repartition(model.buckets, "cell").groupBy("cell")).applyInArrow(score, ROW)
    return _kept(found, "scored").groupBy("part").applyInArrow(add, schema)
