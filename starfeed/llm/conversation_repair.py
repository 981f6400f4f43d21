"""Repair of conversations: the cheapest edits that give a legal order of roles, by bidirectional Dijkstra over the edit lattice."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starfeed.llm.text import map_batches
from starfeed.workspace import written

#: Rows of a conversation that are searched at a time.
SEGMENT = 256
SPACES = " \t\n\x0b\x0c\r"
CLEAN, BLANK, DUPLICATE, TRUNCATED = range(4)
# What the edits cost, and a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, STAYS_TRUNCATED = 0, 1, 2, 5, 5

# The legal orders of role initials, (s?(ua)+)?, as an automaton: nothing yet, after s, after u, after a.
EMPTY, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES, ACCEPTING = range(4), (EMPTY, AFTER_A)
NEXT = {(EMPTY, "s"): AFTER_S, (EMPTY, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
#: The state after a row whose role is chosen: in each state one of user and assistant may follow.
CHOSEN = {EMPTY: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}
ROLES = {AFTER_U: "user", AFTER_A: "assistant"}
LEGAL_NEIGHBOURS = ("su", "ua", "au")

Node = tuple[int, int]
Label = tuple[int, str]


class Repair(NamedTuple):
    """``conversations``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, one row for each conversation.
    ``rows``: conv_id, segment, place, role, text, the repaired rows in the order of segment and place."""

    conversations: DataFrame
    rows: DataFrame


# ---- the edit lattice -------------------------------------------------------------------


def _edits(row: tuple[str, int], state: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next state) of what may be done with a row in a state."""
    initial, fault = row
    yield "D", DELETE, state
    if fault not in (BLANK, DUPLICATE):
        extra = STAYS_TRUNCATED if fault == TRUNCATED else 0
        yield "R", REROLE + extra, CHOSEN[state]
        if (state, initial) in NEXT:
            yield "K", KEEP + extra, NEXT[state, initial]


class _Side:
    """One direction of the search: the label (cost, audit) of each node met, and a heap by cost and then by progress, in which a node
    is settled after all that lead to it without cost. Of labels of one cost the audit that is least counts: those of a node have as many
    letters of rows and, at one cost, as many inserts, so none is the beginning of another."""

    def __init__(self, starts: Iterable[Node], edges: Callable, progress: Callable[[Node], int], joined: Callable[[str, str], str]):
        self.labels: dict[Node, Label] = {}
        self.settled: set[Node] = set()
        self.heap: list[tuple[int, int, Node]] = []
        self.edges, self.progress, self.joined = edges, progress, joined
        for node in starts:
            self.reach(node, (0, ""))

    def reach(self, node: Node, label: Label) -> None:
        old = self.labels.get(node)
        if old is None or label < old:
            self.labels[node] = label
            if old is None or label[0] < old[0]:
                heapq.heappush(self.heap, (label[0], self.progress(node), node))

    def settle(self, other: _Side, best: int | None) -> int | None:
        """Settles the next node; returns the least cost at which the sides meet so far."""
        cost, _, node = heapq.heappop(self.heap)
        if node in self.settled or cost > self.labels[node][0]:
            return best
        self.settled.add(node)
        audit = self.labels[node][1]
        for letter, more, reached in self.edges(node):
            self.reach(reached, (cost + more, self.joined(audit, letter)))
            if reached in other.labels:
                total = self.labels[reached][0] + other.labels[reached][0]
                best = total if best is None else min(best, total)
        return best


def cheapest(rows: list[tuple[str, int]], start: int = EMPTY, ends: tuple[int, ...] = ACCEPTING) -> Label | None:
    """(cost, audit) of the cheapest edits that lead ``rows``, as (role's initial, fault), from a state to one of ``ends``; of equal costs the
    audit that is least in ASCII. None if there is no way.

    A node is a number of rows done and a state. A forward and a reverse heap settle nodes until no way through what is left can be as
    cheap as the best crossing; then every cheapest way crosses a node that both have met, and the least joined audit is taken.
    """
    last = len(rows)

    def ahead(node: Node) -> Iterator[tuple[str, int, Node]]:
        i, state = node
        yield "I", INSERT, (i, CHOSEN[state])
        if i < last:
            for letter, cost, after in _edits(rows[i], state):
                yield letter, cost, (i + 1, after)

    def back(node: Node) -> Iterator[tuple[str, int, Node]]:
        i, state = node
        for before in STATES:
            if CHOSEN[before] == state:
                yield "I", INSERT, (i, before)
            if i:
                for letter, cost, after in _edits(rows[i - 1], before):
                    if after == state:
                        yield letter, cost, (i - 1, before)

    forward = _Side([(0, start)], ahead, lambda node: node[0], lambda audit, letter: audit + letter)
    reverse = _Side([(last, e) for e in ends], back, lambda node: last - node[0], lambda audit, letter: letter + audit)
    best = 0 if not rows and start in ends else None
    while forward.heap and reverse.heap and (best is None or forward.heap[0][0] + reverse.heap[0][0] <= best):
        side, other = (forward, reverse) if forward.heap[0][0] <= reverse.heap[0][0] else (reverse, forward)
        best = side.settle(other, best)
    crossings = (
        (label[0] + reverse.labels[node][0], label[1] + reverse.labels[node][1]) for node, label in forward.labels.items() if node in reverse.labels
    )
    return min(crossings, default=None)


# ---- segments -----------------------------------------------------------------------------

PATH = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
SEGMENTS = pa.schema(
    [("conv_id", pa.int64()), ("segment", pa.int64())]
    + [(c, pa.int64()) for c in ("first_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal")]
    + [("first_initial", pa.string()), ("last_initial", pa.string()), ("paths", pa.list_(PATH))]
)
SEGMENTS_DDL = (
    "conv_id long, segment long, first_turn long, last_turn long, turns long, blank long, duplicate long, truncated long, illegal long, "
    "first_initial string, last_initial string, paths array<struct<start: int, end: int, cost: long, audit: string>>"
)
PIECE = pa.struct([("segment", pa.int64()), ("start", pa.int32()), ("audit", pa.string())])
MERGED = pa.schema(
    [("conv_id", pa.int64())]
    + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("pieces", pa.list_(PIECE))]
)
MERGED_DDL = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "pieces array<struct<segment: long, start: int, audit: string>>"
)
REPAIRED = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
REPAIRED_DDL = "conv_id long, segment long, place long, role string, text string"


def _groups(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[list[dict]]:
    """The rows of each key of a sorted input."""
    now, group = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if group and key != now:
                yield group
                group = []
            now = key
            group.append(row)
    if group:
        yield group


def _sent(rows: Iterable[dict], schema: pa.Schema, many: int = 2000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == many:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL_NEIGHBOURS for a, b in zip(initials, initials[1:]))


def _solver(last_rows: frozenset[int]):
    """Searches segments. One that a neighbouring segment may continue is searched from, or to, every state."""

    def solved(group: list[dict]) -> dict:
        rows = [(r["initial"], DUPLICATE if r["fault"] != BLANK and not r["fresh"] else r["fault"]) for r in group]
        faults, initials = [f for _, f in rows], [i for i, _ in rows]
        turns = [r["turn"] for r in group if r["turn"] is not None]
        starts = STATES if group[0]["at"] % SEGMENT == 0 else (EMPTY,)
        goes_on = group[-1]["at"] % SEGMENT == SEGMENT - 1 or group[-1]["at"] in last_rows
        paths = []
        for start in starts:
            for ends in [(s,) for s in STATES] if goes_on else [ACCEPTING]:
                if (found := cheapest(rows, start, ends)) is not None:
                    paths.append({"start": start, "end": ends[0], "cost": found[0], "audit": found[1]})
        return {
            "conv_id": group[0]["conv_id"], "segment": group[0]["segment"],
            "first_turn": min(turns, default=None), "last_turn": max(turns, default=None), "turns": len(set(turns)),
            "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED), "illegal": _illegal(initials),
            "first_initial": initials[0], "last_initial": initials[-1], "paths": paths,
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _sent((solved(g) for g in _groups(batches, ("conv_id", "segment"))), SEGMENTS)

    return run


def _joined(a: dict, b: dict) -> dict:
    """The cheapest ways through two neighbouring stretches, (start, end) -> (cost, audit, trace). The part of a way in each stretch
    is itself the cheapest between its ends, the least in ASCII at that."""
    out: dict = {}
    for (start, middle), (cost, audit, trace) in a.items():
        for (inner, end), (more, rest, tail) in b.items():
            if inner == middle:
                way = (cost + more, audit + rest, (trace, tail))
                if (start, end) not in out or way[:2] < out[start, end][:2]:
                    out[start, end] = way
    return out


def _pieces(trace: tuple) -> Iterator[dict]:
    open_ = [trace]
    while open_:
        x = open_.pop()
        if isinstance(x, dict):
            yield x
        else:
            open_ += [x[1], x[0]]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Puts the segments of each conversation together, two and two, so that no audit is copied more often than the logarithm of their number."""

    def merged(group: list[dict]) -> dict:
        ways = [
            {(p["start"], p["end"]): (p["cost"], p["audit"], {"segment": g["segment"], "start": p["start"], "audit": p["audit"]}) for p in g["paths"]}
            for g in group
        ]
        while len(ways) > 1:
            ways = [_joined(*ways[i : i + 2]) if i + 1 < len(ways) else ways[i] for i in range(0, len(ways), 2)]
        cost, audit, trace = min((w for (start, end), w in ways[0].items() if start == EMPTY and end in ACCEPTING), key=lambda w: w[:2])
        dated = [g for g in group if g["turns"]]
        distinct = sum(g["turns"] for g in dated) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(dated, dated[1:]))
        return {
            "conv_id": group[0]["conv_id"],
            "gaps": dated[-1]["last_turn"] - dated[0]["first_turn"] + 1 - distinct if dated else 0,
            **{c: sum(g[c] for g in group) for c in ("blank", "duplicate", "truncated")},
            "illegal": sum(g["illegal"] for g in group) + sum(_illegal([a["last_initial"], b["first_initial"]]) for a, b in zip(group, group[1:])),
            "cost": cost, "audit": audit, "pieces": list(_pieces(trace)),
        }

    yield from _sent((merged(g) for g in _groups(batches, ("conv_id",))), MERGED, 500)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired rows of each segment: its piece of the audit comes first, then its rows."""

    def out(group: list[dict]) -> Iterator[dict]:
        piece, rows = group[0], iter(group[1:])
        state, place = piece["start"], 0
        for letter in piece["audit"]:
            row = next(rows) if letter != "I" else {"text": ""}
            if letter == "D":
                continue
            if letter == "K":
                state, role = NEXT[state, row["role"][:1]], row["role"]
            else:
                state = CHOSEN[state]
                role = ROLES[state]
            yield {"conv_id": piece["conv_id"], "segment": piece["segment"], "place": place, "role": role, "text": row["text"]}
            place += 1

    def rows() -> Iterator[dict]:
        for group in _groups(batches, ("conv_id", "segment")):
            yield from out(group)

    yield from _sent(rows(), REPAIRED, 200)


# ---- on tables ----------------------------------------------------------------------------


def _fault(text: Column) -> Column:
    end = F.rtrim(text, F.lit(SPACES))
    return F.when(end == "", BLANK).when(F.substring(end, -1, 1).isin(".", "!", "?"), CLEAN).otherwise(TRUNCATED)


def in_order(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, initial, fault, digest, at, segment) written in the order of conversation, turn (nulls first), role and text.

    Dealt by ranges of these, so that a conversation of very many rows lies in many tasks; ``at`` numbers the rows in that order, without gaps in a task.
    """
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
    )
    # the beginning of a text is enough to deal it out in order, and the driver gets a sample of what rows are dealt by
    dealt = rows.repartitionByRange("conv_id", "turn", F.substring("role", 1, 16), F.substring("text", 1, 32))
    dealt = dealt.sortWithinPartitions("conv_id", "turn", "role", "text").withColumn("at", F.monotonically_increasing_id())
    pair = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return written(
        dealt.withColumns(
            {
                "initial": F.substring("role", 1, 1), "fault": _fault(F.col("text")), "digest": F.unhex(F.md5(pair.cast("binary"))),
                "segment": F.expr(f"at div {SEGMENT}"),
            }
        ),
        "conversations",
    )


def repaired(turns: DataFrame, **names: str) -> Repair:
    """The repair of each conversation; ``names`` are the columns (see ``in_order``).

    Rows are taken by turn, nulls first, equal turns by role and text; a null role or text counts as one blank, rows of a null conv_id are one conversation. A row's
    first fault counts: no character but spaces (blank), role and text of an earlier row (duplicate), last character but spaces none of ``.!?``
    (truncated). Edits are Keep (cost 0), Rerole to user or assistant (1), Delete (2; blank and duplicate rows must go) and Insert an
    empty row of user or assistant (5); a truncated row that stays costs 5 more. The result's role initials are ``(s?(ua)+)?``; an
    empty role has none and does not stay as it is. ``audit`` lists the initials of the cheapest edits, ties by ASCII order.

    Conversations are searched ``SEGMENT`` rows at a time, from and to every state where more rows may lie beside, and the segments'
    ways joined, so a conversation of any length is spread over tasks; only what its segments come to (a few bytes a row) meets in one. Texts move
    once to be sorted and once to be repaired. An empty table gives no rows.
    """
    rows = in_order(turns, **names)
    # one number for each task
    ends = rows.groupBy(F.shiftright("at", 33)).agg(F.max("at").alias("at")).collect()
    marks = rows.select("conv_id", "segment", "at", "turn", "initial", "fault", "digest")
    fresh = marks.groupBy("conv_id", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("fresh"))
    marks = marks.drop("digest").join(fresh, "at", "left").withColumn("fresh", F.coalesce("fresh", F.lit(False)))
    grouped = marks.repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "at")
    segments = map_batches(grouped, _solver(frozenset(r["at"] for r in ends)), SEGMENTS_DDL)
    sorted_segments = segments.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    merged = written(map_batches(sorted_segments, _merge, MERGED_DDL), "repairs")

    pieces = merged.select("conv_id", F.explode("pieces").alias("p")).select(
        "conv_id", "p.segment", F.lit(-1).cast("long").alias("at"), "p.start", "p.audit", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text")
    )
    both = pieces.union(rows.select("conv_id", "segment", "at", F.lit(None).cast("int"), F.lit(None).cast("string"), "role", "text"))
    both = both.repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "at")
    return Repair(merged.drop("pieces"), map_batches(both, _apply, REPAIRED_DDL))


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, sha256) of the ``role:text`` of each conversation's repaired rows, joined by line breaks. A digest takes its input in order, so
    the rows of a conversation stream through one task, which holds one batch of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[dict]:
            now, digest = None, None
            for batch in batches:
                for row in batch.to_pylist():
                    if digest is None or row["conv_id"] != now:
                        if digest is not None:
                            yield {"conv_id": now, "sha256": digest.hexdigest()}
                        now, digest = row["conv_id"], hashlib.sha256()
                    else:
                        digest.update(b"\n")
                    digest.update(f"{row['role']}:{row['text']}".encode())
            if digest is not None:
                yield {"conv_id": now, "sha256": digest.hexdigest()}

        yield from _sent(out(), pa.schema([("conv_id", pa.int64()), ("sha256", pa.string())]))

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "place")
    return map_batches(ordered, run, "conv_id long, sha256 string")


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``turns`` with faults written in by the checksum of ``conv_id:turn`` modulo 20 (a null is one blank, there and in role and text): 0 drops the row, 1 empties
    its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes it the user's."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col)]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    text, role = F.coalesce(F.col(text_col), F.lit(" ")), F.coalesce(F.col(role_col), F.lit(" "))
    rows = turns.withColumn("_kind", kind).where("_kind <> 0")
    rows = rows.withColumns(
        {
            text_col: F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate(text, ".!?", "")).otherwise(text),
            role_col: F.when(F.col("_kind") == 4, "user").otherwise(role),
            "_copy": F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
        }
    )
    return rows.drop("_kind", "_copy")
