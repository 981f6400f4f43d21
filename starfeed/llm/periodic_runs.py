"""Periodic runs of words, found by longest-common-extension queries on a run-length grammar made by recompression."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from starfeed.llm.text import WORD, chunks, columns, map_batches, mixed

LEAST_LENGTH, LEAST_PERIODS = 24, 3
#: Grid places looked at together.
PLACES = 1 << 20
BOUNDARY = -1
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


class Grammar:
    """A run-length grammar of a sequence, by recompression: rounds of block compression (a block of equal symbols becomes
    one) alternate with rounds of pair compression (the symbols are dealt to two sides, and a left one followed by a right one becomes
    one symbol), until each part between two boundaries is a single symbol.

    ``words`` are numbers from 0 on and ``BOUNDARY`` between the parts, first and last; boundaries are never compressed.
    A round is kept as its symbols, the place in the next round of each, and where each symbol of the next round begins in it.
    How a symbol is compressed depends on its neighbours alone, so equal stretches are compressed alike but at their ends.
    """

    def __init__(self, words: np.ndarray):
        self.symbols = [words.astype(np.int32)]
        self.parent: list[np.ndarray] = []
        self.child: list[np.ndarray] = []
        self.parts = int((words == BOUNDARY).sum())
        self.next_id = int(words.max(initial=-1)) + 1
        while len(self.symbols[-1]) > 2 * self.parts - 1:
            (self._pairs if len(self.parent) % 2 else self._blocks)()

    def _blocks(self) -> None:
        row = self.symbols[-1]
        starts = np.concatenate([[True], (row[1:] != row[:-1]) | (row[1:] == BOUNDARY)])
        at = np.flatnonzero(starts)
        length = np.diff(at, append=len(row))
        out = row[at]
        long = np.flatnonzero(length > 1)
        out[long] = self._names(out[long], length[long])
        self._add(starts, at, out)

    def _pairs(self) -> None:
        row = self.symbols[-1]
        seed = np.uint64(len(self.parent) * 0x9E3779B97F4A7C15 & (2**64 - 1))
        left = (mixed(row.astype(np.uint64) ^ seed) & np.uint64(1)).astype(bool)
        word = row != BOUNDARY
        second = np.concatenate([[False], word[:-1] & word[1:] & left[:-1] & ~left[1:]])
        at = np.flatnonzero(~second)
        out = row[at]
        joined = np.flatnonzero(np.diff(at, append=len(row)) > 1)
        out[joined] = self._names(out[joined], row[at[joined] + 1])
        self._add(~second, at, out)

    def _names(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """One new symbol for each different (a, b)."""
        _, names = np.unique(a.astype(np.int64) << 32 | b.astype(np.int64), return_inverse=True)
        names = (names + self.next_id).astype(np.int32)
        self.next_id = int(names.max(initial=self.next_id - 1)) + 1
        return names

    def _add(self, starts: np.ndarray, at: np.ndarray, out: np.ndarray) -> None:
        self.parent.append((np.cumsum(starts) - 1).astype(np.int32))
        self.child.append(np.append(at, len(starts)).astype(np.int32))
        self.symbols.append(out)

    # ---- queries ----

    def _first(self, level: int, at: np.ndarray) -> np.ndarray:
        """Whether a symbol of the next round begins there."""
        return self.child[level][self.parent[level][at]] == at

    def _step(self, level: int, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        """How many of the equal symbols beside a and b to pass: one before pair compression, all that both blocks have left before
        block compression. ``way`` 1: to the right of them, -1: to the left."""
        if level % 2:
            return np.ones(len(a), np.int32)
        if way > 0:
            rest = [self.child[level][self.parent[level][x] + 1] - x for x in (a, b)]
        else:
            rest = [x - self.child[level][self.parent[level][x - 1]] for x in (a, b)]
        return np.minimum(*rest)

    def extensions(self, a: np.ndarray, b: np.ndarray, way: int = 1) -> np.ndarray:
        """For each pair of different places in one part how far the words from them on agree (``way`` 1), or those before them (-1).

        A pair climbs while the symbols beside it agree: it passes those that the next round does not begin with, at most
        one step, and goes on in the next round. Where they differ it descends again, passing what their first halves share.
        """
        side = 0 if way > 0 else -1
        a, b = a.astype(np.int32), b.astype(np.int32)
        origin, length = a.copy(), np.zeros(len(a), np.int32)
        climbing, halted, level = np.arange(len(a)), [], 0
        while len(climbing):
            row = self.symbols[level]
            for last in (False, True):
                x, y = a[climbing], b[climbing]
                same = row[x + side] == row[y + side]
                halted.append((level, climbing[~same]))
                climbing, x, y = climbing[same], x[same], y[same]
                if last:
                    break
                move = ~(self._first(level, x) & self._first(level, y))
                moved = climbing[move]
                step = way * self._step(level, x[move], y[move], way)
                a[moved] += step
                b[moved] += step
            a[climbing] = self.parent[level][a[climbing]]
            b[climbing] = self.parent[level][b[climbing]]
            level += 1
        falling = np.zeros(0, np.int64)
        for k in range(level - 1, -1, -1):
            falling = np.concatenate([falling, *(found for at, found in halted if at == k)])
            if k == 0:
                break
            a[falling], b[falling] = self.child[k - 1][a[falling]], self.child[k - 1][b[falling]]
            row, open_ = self.symbols[k - 1], falling
            while len(open_):
                x, y = a[open_], b[open_]
                same = row[x + side] == row[y + side]
                open_, x, y = open_[same], x[same], y[same]
                step = way * self._step(k - 1, x, y, way)
                a[open_] += step
                b[open_] += step
        length[:] = way * (a - origin)
        return length


def _grid(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place, period, first) of the grid places that may lie in a run of the period, a bounded number at a time.

    A run of period q has max(least, times * q) words or more, so the words that recur q later are a stretch of at least two steps of
    the grid, whose step is q for three periods: two neighbouring grid places lie in it, and the first of them is kept.
    ``first`` marks those whose grid place before is not kept.
    """
    periods = sizes // times
    part = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(part)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = np.maximum(np.maximum(least - period, (times - 1) * period) // 2, 1)
    count = np.maximum((sizes[part] - 1 - period - step) // step + 1, 0)
    ends = np.cumsum(count)
    at = 0
    while at < len(part):
        until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PLACES, "right")))
        some = slice(at, until)
        n = count[some]
        inside = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(np.cumsum(n) - n, n)
        q, g = np.repeat(period[some], n), np.repeat(step[some], n)
        place = np.repeat(starts[part[some]], n) + inside * g
        kept = words[place] == words[place + q]
        place, q, g, inside = place[kept], q[kept], g[kept], inside[kept]
        kept = words[place + g] == words[place + g + q]
        place, q, g, inside = place[kept], q[kept], g[kept], inside[kept]
        first = np.ones(len(place), bool)
        first[1:] = (place[1:] != place[:-1] + g[1:]) | (q[1:] != q[:-1]) | (inside[1:] == 0)
        yield place, q, first
        at = until


def runs_of(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of several texts, which lie in ``words`` with a boundary before and after each.

    Every stretch found is extended as far as its period goes, and the least period with which a stretch is found is its smallest: a
    smaller one has it as a multiple and is found in the same stretch.
    """
    grammar = Grammar(words)
    found: list[np.ndarray] = []
    for place, period, first in _grid(words, starts, sizes, least, times):
        chain = np.cumsum(first)
        while len(place):  # the first place of each chain; those inside its stretch are of the same run
            head = np.concatenate([[True], chain[1:] != chain[:-1]])
            x, q = place[head], period[head]
            ahead = grammar.extensions(x, x + q)
            behind = grammar.extensions(x, x + q, -1)
            start, end = x - behind, x + q + ahead
            run = end - start >= np.maximum(least, times * q)
            found.append(np.stack([start[run], end[run], q[run]], 1))
            reach = np.repeat(x + ahead, np.diff(np.flatnonzero(head), append=len(place)))
            rest = (place >= reach) & ~head
            place, period, chain = place[rest], period[rest], chain[rest]
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    smallest = np.ones(len(rows), bool)
    smallest[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
    return rows[smallest, 0], rows[smallest, 1], rows[smallest, 2]


def _batch(texts: list[str | None], least: int, times: int) -> tuple[list[list[tuple[int, int, int]]], list[str], list[int]]:
    """Of each text its runs as (start, length, period), its collapsed words and how many words it has."""
    split = [WORD.findall(t) if t else [] for t in texts]
    sizes = np.asarray([len(w) for w in split], np.int64)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in split]
    long = np.flatnonzero(sizes >= least)
    if len(long):
        ids: dict[str, int] = {}
        flat = [BOUNDARY]
        for i in long:
            flat += [ids.setdefault(w, len(ids)) for w in split[i]]
            flat.append(BOUNDARY)
        starts = np.cumsum(sizes[long] + 1) - sizes[long]
        found = runs_of(np.asarray(flat, np.int64), starts, sizes[long], least, times)
        owner = np.searchsorted(starts, found[0], "right") - 1
        for k, start, end, q in zip(owner.tolist(), (found[0] - starts[owner]).tolist(), (found[1] - starts[owner]).tolist(), found[2].tolist()):
            runs[long[k]].append((start, end - start, q))
        for of in runs:
            of.sort(key=lambda r: (r[0], r[2]))
    collapsed = []
    for words, of in zip(split, runs):
        if of:
            keep = np.ones(len(words), bool)
            for start, length, q in of:
                keep[start + q : start + length] = False
            words = [words[i] for i in np.flatnonzero(keep)]
        collapsed.append(" ".join(words))
    return runs, collapsed, sizes.tolist()


def periodic_runs(
    docs: DataFrame,
    text_col: str = "text",
    keep: list[Column] | None = None,
    least: int = LEAST_LENGTH,
    times: int = LEAST_PERIODS,
) -> DataFrame:
    """(_row, n_words, runs array<struct<start, length, period>>, collapsed) for each row; ``_row`` has the ``keep`` columns, or all.

    Words are stretches without spaces (blank, tab to carriage return), compared exactly. A run is a stretch of
    words with smallest period q and ``least`` and ``times * q`` words or more that no neighbouring word extends; runs are listed by start, then
    period, and may overlap. ``collapsed`` are the words, joined by a blank, that no run contains after its first period.

    Texts are worked on some two million characters at a time, a longer one by itself and whole: its task holds
    about 100 bytes for each of its words, and the grid has n log n places, looked at a million at a time. A null or empty text has no
    words and no runs. Repeated rows are worked on each.
    """
    if least < 2 or times < 2:
        raise ValueError("a run needs two words and two periods at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            runs, collapsed, sizes = _batch(batch.column("text").to_pylist(), least, times)
            rows = np.asarray([r for of in runs for r in of], np.int64).reshape(-1, 3)
            offsets = np.concatenate([[0], np.cumsum([len(of) for of in runs])])
            fields = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], ["start", "length", "period"])
            yield pa.record_batch(
                [batch.column("_row"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), fields), pa.array(collapsed, pa.string())],
                ["_row", "n_words", "runs", "collapsed"],
            )

    source = docs.select(F.struct(*(columns(docs) if keep is None else keep)).alias("_row"), F.col(text_col).alias("text"))
    out = T.StructType([source.schema["_row"]]).add("n_words", "long").add("runs", RUNS).add("collapsed", "string")
    return map_batches(source, run, out)


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a repetition written into the texts of a tenth of the ids, picked by the ids' checksum h: with g = h // 10, the words from
    a = g % n on are replaced by the 1 + (n - a) // (3 + g % 8) words from there, over and over. The others, null ids too, stay as they are."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.filter(F.split(F.col(text_col), "[\\x20\\x09-\\x0D]+"), lambda w: F.length(w) > 0)
    planted = F.expr(
        "array_join(transform(_w, (x, i) -> if(i < _a, x, _w[int(_a + pmod(i - _a, _p))])), ' ')"
    )
    picked = F.coalesce((h % 10 == 0) & F.rlike(F.col(text_col), F.lit("[^\\x20\\x09-\\x0D]")), F.lit(False))
    rows = docs.withColumn("_w", F.when(picked, words)).withColumn("_g", F.floor(h / 10).cast("long"))
    rows = rows.withColumn("_a", F.when(picked, F.col("_g") % F.size("_w")))
    rows = rows.withColumn("_p", F.expr("1 + (size(_w) - _a) div (3 + _g % 8)"))
    return rows.withColumn(text_col, F.when(picked, planted).otherwise(F.col(text_col))).drop("_w", "_g", "_a", "_p")
