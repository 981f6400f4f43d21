"""Periodic runs against a scan of every period, on random texts, odd rows and a small table."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from odd import ODD, documents
from pyspark.sql import functions as F

from starfeed.llm import periodic_runs as pr
from starfeed.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


def brute_runs(words, least=24, times=3):
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapse(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


pieces = st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 12)), max_size=5)


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(pieces, min_size=1, max_size=4), limits=st.sampled_from([(24, 3), (6, 2), (4, 3), (10, 4)]))
def test_runs_equal_a_scan(texts, limits):
    texts = [" ".join(" ".join(piece * times) for piece, times in t) for t in texts]
    runs, collapsed, sizes = pr._batch(texts, *limits)
    for text, found, rest, n in zip(texts, runs, collapsed, sizes):
        words = text.split()
        expected = sorted(brute_runs(words, *limits), key=lambda r: (r[0], r[2]))
        assert found == expected and n == len(words) and rest == collapse(words, expected)


@settings(max_examples=60, deadline=None)
@given(parts=st.lists(st.lists(st.integers(0, 2), min_size=2, max_size=60), min_size=1, max_size=3))
def test_extensions_equal_a_comparison(parts):
    row = [pr.BOUNDARY]
    for part in parts:
        row += [*part, pr.BOUNDARY]
    grammar, row = pr.Grammar(np.asarray(row, np.int64)), list(row)
    at, pairs = 1, []
    for part in parts:
        pairs += [(at + i, at + j) for i in range(len(part)) for j in range(i + 1, len(part))]
        at += len(part) + 1

    def agree(a, b, way):
        n = 0
        while row[a + way * n] == row[b + way * n] != pr.BOUNDARY:
            n += 1
        return n

    a, b = np.asarray(pairs).T
    assert grammar.extensions(a, b).tolist() == [agree(x, y, 1) for x, y in pairs]
    assert grammar.extensions(a, b, -1).tolist() == [agree(x - 1, y - 1, -1) for x, y in pairs]


def test_the_grid_is_looked_at_in_parts(monkeypatch):
    monkeypatch.setattr(pr, "PLACES", 7)
    words = ("x y z " * 30 + "a b " * 20 + "x y z " * 9).split()
    assert pr._batch([" ".join(words)], 24, 3)[0] == [brute_runs(words)]


def test_a_very_long_text():
    text = "a b c " * 300_000 + "d"
    runs, collapsed, _ = pr._batch([text], 24, 3)
    assert runs == [[(0, 900_000, 3)]] and collapsed == ["a b c d"]


def test_odd_rows_and_empty_tables(spark):
    docs = documents(spark, [*ODD, (20, "go " * 30 + "on", "en", "s")])
    got = pr.periodic_runs(docs)
    rows = got.collect()
    assert got.select("_row.*").columns == docs.columns and len(rows) == len(ODD) + 1
    for r in rows:
        words = WORD.findall(r["_row"]["text"] or "")
        assert r["n_words"] == len(words)
        if len(words) < 5000:
            expected = brute_runs(words)
            assert [tuple(x) for x in r["runs"]] == expected and r["collapsed"] == collapse(words, expected)
    assert {r["_row"]["doc_id"] for r in rows if r["runs"]} >= {1, 20}
    assert pr.periodic_runs(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        pr.periodic_runs(docs, times=1)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def test_planting(spark):
    rows = [(i, f" w{i} x\ty\n z " * 12 if i % 7 else " ", "en", "s") for i in range(60)] + [(None, "a b", "en", "s"), (3, None, "en", "s")]
    for r in pr.with_planted_runs(documents(spark, rows).withColumn("_keep", F.col("text"))).collect():
        words = WORD.findall(r["_keep"] or "")
        assert WORD.findall(r["text"] or "") == planted(r["doc_id"], words)


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op11_recompression_runs"](spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        words = planted(r["doc_id"], WORD.findall(texts[r["doc_id"]] or ""))
        if len(words) > 4000:
            continue
        runs = brute_runs(words)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda x: (x[0], x[2])))
        assert tuple(r)[1:] == (
            len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapse(words, runs).encode()).hexdigest(),
        )
    assert sum(r["n_runs"] > 0 for r in rows) > 5
