"""Repaired conversations against a search that tries every way, on random rows, odd rows and a small table."""

import collections
import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from starfeed.llm import conversation_repair as cr
from starfeed.llm.queries import QUERIES

LEGAL = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"
SMALL = "/root/testdata/sf0.01"


def plain_search(rows):
    """(cost, audit) by relaxing the labels of all nodes until none changes."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    labels = {(0, ""): (0, "")}
    changed = True
    while changed:
        changed = False
        for (i, state), (cost, audit) in list(labels.items()):
            ways = [(i, step[state, x], 5, "I") for x in "ua" if (state, x) in step]
            if i < len(rows):
                initial, fault = rows[i]
                ways.append((i + 1, state, 2, "D"))
                if fault not in (cr.BLANK, cr.DUPLICATE):
                    more = 5 * (fault == cr.TRUNCATED)
                    ways += [(i + 1, step[state, x], 1 + more, "R") for x in "ua" if (state, x) in step]
                    ways += [(i + 1, step[state, initial], more, "K")] if (state, initial) in step else []
            for j, after, price, letter in ways:
                new = (cost + price, audit + letter)
                if len(new[1]) <= 2 * len(rows) + 2 and new < labels.get((j, after), (10**9, "")):
                    labels[j, after] = new
                    changed = True
    return min(labels[len(rows), s] for s in ("", "a") if (len(rows), s) in labels)


rows_of = st.lists(st.tuples(st.sampled_from("sua "), st.sampled_from([0, 0, 0, 1, 2, 3])), max_size=9)


@settings(max_examples=400, deadline=None)
@given(rows=rows_of)
def test_the_cheapest_way(rows):
    assert cr.cheapest(rows) == plain_search(rows)


@settings(max_examples=100, deadline=None)
@given(rows=st.lists(st.tuples(st.sampled_from("sua"), st.sampled_from([0, 0, 3])), min_size=2, max_size=14), cut=st.integers(1, 13))
def test_joined_segments_equal_one_search(rows, cut):
    def ways(part, starts, ends):
        found = {(s, e[0]): cr.cheapest(part, s, e) for s in starts for e in ends}
        return {k: (*v, {"segment": 0, "start": k[0], "audit": v[1]}) for k, v in found.items() if v is not None}

    joined = cr._joined(ways(rows[:cut], [0], [(s,) for s in cr.STATES]), ways(rows[cut:], cr.STATES, [cr.ACCEPTING]))
    assert min(w[:2] for (s, _), w in joined.items() if s == 0) == cr.cheapest(rows)


def test_no_way():
    assert cr.cheapest([], cr.AFTER_S, (cr.EMPTY,)) is None
    assert cr.cheapest([]) == (0, "")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def expected(rows, search=plain_search):
    by = collections.defaultdict(list)
    for conv, turn, role, text in damage(rows):
        by[conv].append((turn is not None, turn or 0, role.encode(), text.encode(), role, text))
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(by[conv], key=lambda r: r[:4])
        seen, faults = set(), []
        for *_, role, text in own:
            trimmed = text.strip(SPACE)
            faults.append(1 if not trimmed else 2 if (role, text) in seen else 0 if trimmed[-1] in ".!?" else 3)
            seen.add((role, text))
        roles = [r[4] for r in own]
        turns = [r[1] for r in own if r[0]]
        cost, audit = search([(x[:1], f) for x, f in zip(roles, faults)])
        repaired, state, at = [], "", 0
        for letter in audit:
            row = own[at] if letter != "I" else None
            at += letter != "I"
            if letter == "D":
                continue
            role = row[4] if letter == "K" else "assistant" if state == "u" else "user"
            repaired.append((role, row[5] if row else ""))
            state = role[0]
        assert LEGAL.fullmatch("".join(r[0] for r, _ in repaired))
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out[conv] = (gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, digest)
    return out


@pytest.fixture
def query(spark, tmp_path):
    def run(rows):
        frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        frame.selectExpr("*", "1 as at", "'x' as segment", "'y' as audit").write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
        return {r["conv_id"]: tuple(r)[1:] for r in QUERIES["op13_lattice_repair"](spark, str(tmp_path)).collect()}

    return run


ODD = [
    *[(1, t, "user" if t % 2 else "assistant", "Yes.") for t in range(9)],
    *[(2, t, "tool", f"It is {t}") for t in range(5)],
    (3, None, None, None), (3, None, "user", "Hi!"), (3, 7, "user", "Hi!"), (3, 7, "user", "Hi!"), (3, 9, "system", "long " * 30_000 + "."),
    (4, 0, "system", " \t\r\n\x0b\x0c "), (4, 1, "", "no role."), (4, 2, "User", "Capital?"),
    (None, 1, "user", "lost."), (None, 2, "assistant", "found.\n \n"), (5, 3, "user", "é🙂?"), (5, 100, "assistant", "ü。"),
    *[(6, t, "system", "Same!") for t in range(4)], (7, None, "user", None), (8, 1, "s", "x"),
]


def test_odd_rows(query):
    assert query(ODD) == expected(ODD)
    assert query([]) == {}


def test_long_conversations_are_searched_in_segments(spark, query, monkeypatch):
    monkeypatch.setattr(cr, "SEGMENT", 8)
    rows = [(1, t, ("system", "user", "assistant")[t * t % 7 % 3], f"Line {t % 23}{'.' if t % 5 else ''}") for t in range(150)]
    rows += [(9 + t // 3, t, "user", "Hello.") for t in range(40)]
    whole = lambda r: cr.cheapest(r)  # noqa: E731  equals the plain search, above
    assert query(rows) == expected(rows, whole)


def test_all_rows_lost(query):
    lost = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    assert query([(5, lost, "user", "Gone.")])[5] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in QUERIES["op13_lattice_repair"](spark, SMALL).collect()}
    assert got == expected(rows)
