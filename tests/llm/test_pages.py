"""Archives, the URL filter and the code search against brute-force versions, on odd rows and small tables."""

import collections
import hashlib
import os
import re

import duckdb
import numpy as np
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F, types as T

from starfeed.llm import hamming_search, url_filter, warc
from starfeed.llm.queries import ORACLE, QUERIES
from starfeed.workspace import work_dir

SF_DIR = "/root/testdata/sf0.01"
BIG = "<p>" + "long payload " * 100
PAGES = [
    (1, "http://www.Example.org:8080/en/12?q#x", BIG),
    (2, "https://example.org/es/1", BIG),
    (3, "http://www.Example.org:8080/en/12?q#x", BIG),
    (3, "http://www.Example.org:8080/en/12?q#x", BIG),
    (4, None, None),
    (5, "", ""),
    (6, "no scheme here", "short"),
    (7, "ftp://short/", "short"),
    (None, "http://a.com/fr/ü nï\r\nX: y", BIG),
    (8, "http://a.com/de/" + "x" * 5000, "é" * 100_000),
    (9, "http://a.com/de/", "é" * 100_000),
    (10, "http://sub.a.ORG", "🙂"),
    (11, "http://org/", "x" * 1000),
    (12, "a://b://c/d", "x" * 999),
    (13, "http://notexample.org/es/", "x" * 999),
]
PAGE_SCHEMA = "page_id long, url string, html string, key string, payload string, digest string, codes string"


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "k", "p", "d", "c") for r in rows], PAGE_SCHEMA)


def expected_records(rows):
    holder = {}
    for page_id, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 1000 and page_id is not None:
            holder[body] = max(holder.get(body, page_id), page_id)
    out = collections.Counter()
    for page_id, _, html in rows:
        body = (html or "").encode()
        of = holder.get(body)
        refers = of if of is not None and (page_id is None or page_id < of) else None
        out[page_id, len(body), hashlib.sha1(body).hexdigest(), "response" if refers is None else "revisit", refers] += 1
    return out


@pytest.mark.parametrize("lines", [2000, 2])
def test_archive_round_trip(spark, lines, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", lines)
    docs = pages(spark).repartition(3)
    got = warc.archive_round_trip(docs).collect()
    assert collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == expected_records(PAGES)
    bodies = {r["page_id"]: bytes(r["payload"]) for r in got if r["record_type"] == "response"}
    assert 8 not in bodies and bodies[9] == ("é" * 100_000).encode() and bodies[4] == b""


def test_look_up_reads_few_blocks_and_misses_unknown_urls(spark):
    folder = work_dir(spark, "warc")
    rows = [(i, f"http://h{i % 7}.example.com/p{i}", f"page {i}") for i in range(3000)]
    index = warc.build_index(warc.write_archives(pages(spark, rows), folder), folder)
    assert sum(1 for f in pafs.LocalFileSystem().get_file_info(pafs.FileSelector(index.folder)) if f.path.endswith(".cdx.gz")) == len(index.shards)
    wanted = spark.createDataFrame([(17, "http://h3.example.com/p17"), (18, "http://h3.example.com/p17"), (5, "http://none/")], "page_id long, url string")
    found = warc.look_up(wanted.select(warc.url_key(F.col("url")).alias("key"), "page_id"), index)
    records = warc.read_records(found, folder).collect()
    assert [(r["page_id"], r["url"], bytes(r["payload"])) for r in records] == [(17, "http://h3.example.com/p17", b"page 17")]


def test_url_keys(spark):
    urls = ["http://www.A.org:80/x?y", "https://a.org", "plain", None, "", "a://b://c"]
    got = spark.createDataFrame([(u,) for u in urls], "url string").select(warc.url_key(F.col("url"))).collect()
    assert [r[0] for r in got] == ["org,a,www:80)/x?y", "org,a)", "plain", "", "", "b:)//c"]


def test_records_are_warc(spark):
    headers, http, payload = warc.parse_record(warc._record("http://a/b c\r\nX: y", 5, "00", 3, b"abc", None))
    assert headers["WARC-Type"] == "response" and headers["WARC-Target-URI"] == "http://a/b%20c%0D%0AX:%20y" and payload == b"abc"
    assert http.startswith(b"HTTP/1.1 200 OK")


# ---- URL filter -----------------------------------------------------------------------


def place(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :]).group()


def rule_of(host, path):
    fits = [(len(h + p), v, h + p) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else None


def test_rules(spark):
    got = url_filter.judged(pages(spark)).collect()
    expected = collections.Counter()
    for page_id, url, _ in PAGES:
        rule = rule_of(*place(url))
        expected[page_id, *place(url), rule[1] if rule else None] += 1
    assert collections.Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in got) == expected
    assert all(r["verdict"] in ("allow", "block") for r in got)
    assert all(r["verdict"] == rule_of(r["host"], r["path"])[0] for r in got if r["rule"])


def test_the_ratio_tells_held_out_urls_apart(spark):
    rng = np.random.default_rng(2)
    name = lambda letters: "".join(rng.choice(list(letters), 8))
    rows = [(i, f"http://{name('abcde')}.org/{name('abcde')}", "") for i in range(150)]
    rows += [(1000 + i, f"http://example.org/es/{name('vwxyz')}{name('vwxyz')}", "") for i in range(150)]
    rows += [(2000 + i, f"http://{name('abcde')}.net/{name('abcde')}", "") for i in range(30)]
    rows += [(3000 + i, f"http://example.net/es/{name('vwxyz')}{name('vwxyz')}", "") for i in range(30)]
    got = {r["page_id"]: r["verdict"] for r in url_filter.judged(pages(spark, rows)).collect()}
    assert sum(got[i] == "allow" for i in range(2000, 2030)) >= 28 and sum(got[i] == "block" for i in range(3000, 3030)) >= 28


def test_ratios_equal_a_plain_model(spark):
    urls = ["http://ab.org/aab", "http://abab.org/", "x://a-b"]
    blocked = ["http://zz.org/z1", "q://zzz"]
    frame = spark.createDataFrame([(u, "allow") for u in urls] + [(u, "block") for u in blocked], "url string, verdict string")
    ratios = url_filter.train(frame.select(url_filter.symbols(F.col("url")).alias("codes"), "verdict")).first()["ratios"]
    n = url_filter.SYMBOLS
    assert len(ratios) == n**3

    def codes(url):
        text = re.sub("^[^/?#]*?://", "", url).lower()
        return [n - 1, n - 1, *(url_filter.ALPHABET.find(c) + 1 for c in text), n - 1]

    def log_p(training, run):
        counts = [collections.Counter() for _ in range(4)]
        for url in training:
            c = codes(url)
            for i in range(2, len(c)):
                for k in (1, 2, 3):
                    counts[k][tuple(c[i - k + 1 : i + 1])] += 1
        p = 1 / n
        for k in (1, 2, 3):
            context = run[3 - k : 2]
            seen = {g: v for g, v in counts[k].items() if g[:-1] == context}
            if seen:
                p = (seen.get(run[3 - k :], 0) + len(seen) * p) / (sum(seen.values()) + len(seen))
        return np.log(p)

    for url in urls + blocked:
        c = codes(url)
        for i in range(2, len(c)):
            run = tuple(c[i - 2 : i + 1])
            assert ratios[run[0] * n * n + run[1] * n + run[2]] == pytest.approx(log_p(urls, run) - log_p(blocked, run))


def test_the_native_operators_plan_no_python(spark):
    for name in ("op6_url_likelihood_ratio", "op9_bootstrapped_pii"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# ---- code search ----------------------------------------------------------------------


def brute_top_k(rows, queries, k):
    out = collections.Counter()
    for i, code in queries:
        near = sorted((bin((code ^ c) & (2**64 - 1)).count("1"), j) for j, c in rows if j != i and c is not None and j is not None) if code is not None else []
        out[i, tuple(near[:k])] += 1
    return out


@pytest.mark.parametrize("size", [1, 3, 40, 400])
def test_top_k_equals_brute_force(spark, size):
    rng = np.random.default_rng(size)
    rows = [(i, int(rng.integers(-(2**63), 2**63 - 1))) for i in range(size)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)] + [(2000 + i, rows[0][1] ^ (1 << i)) for i in range(20)] + [(5000, None), (None, 1), (1001, rows[0][1])]
    schema = "id long, code long"
    queries = [r for r in rows if r[0] is not None and r[0] % 5 == 0]
    got = hamming_search.top_k(spark.createDataFrame(rows, schema), spark.createDataFrame(queries, schema), 10)
    assert collections.Counter((r["id"], tuple((x["distance"], x["id"]) for x in r["neighbours"])) for r in got.collect()) == brute_top_k(sorted(set(rows), key=str), queries, 10)


def test_only_the_nearest_ids_leave_a_task(spark, monkeypatch):
    """Of each asked code and block at most k + 1, however many candidates its buckets hold; several blocks and groups, codes alike in a segment, an id with many codes."""
    monkeypatch.setattr(hamming_search, "BLOCK", 700)
    monkeypatch.setattr(hamming_search, "GROUP", 90)
    rng = np.random.default_rng(6)
    rows = [(i, int(rng.integers(-(2**63), 2**63 - 1)) & ~(0xFFFFF << 20)) for i in range(2000)]
    rows += [(5, rows[5][1] ^ (1 << b)) for b in range(14)] + [(9000 + i, rows[10][1]) for i in range(60)]
    queries = [r for r in rows if r[0] % 10 in (0, 5)]
    moved, written = {}, hamming_search.written

    def noted(df, label):
        out = written(df, label)
        moved[label] = out.count()
        if label == "found":
            assert out.agg(F.max(F.size("near"))).first()[0] <= 10 + 15
        return out

    monkeypatch.setattr(hamming_search, "written", noted)
    got = hamming_search.top_k(spark.createDataFrame(rows, "id long, code long"), spark.createDataFrame(queries, "id long, code long"), 10)
    assert collections.Counter((r["id"], tuple((x["distance"], x["id"]) for x in r["neighbours"])) for r in got.collect()) == brute_top_k(rows, queries, 10)
    assert moved["found"] == 3 * moved["asked"]


@pytest.mark.parametrize("n, bits", [(1, 64), (300, 64), (3000, 12), (5000, 20), (40000, 64), (40000, 30)])
def test_a_block_is_searched_exactly(n, bits):
    rng = np.random.default_rng(n + bits)
    codes = np.unique(rng.integers(-(2**63), 2**63 - 1, n) & ((1 << bits) - 1 if bits < 64 else -1))
    sizes = rng.integers(1, 12, len(codes))
    starts, ids = np.concatenate([[0], np.cumsum(sizes)]), rng.permutation(sizes.sum())
    for a, b in zip(starts, starts[1:]):
        ids[a:b].sort()
    asked = np.concatenate([codes[:20], rng.integers(-(2**63), 2**63 - 1, 20)])
    row, distance, found = hamming_search.Block(codes, starts, ids).search(asked, 11)
    own = np.repeat(codes, sizes)
    for i, a in enumerate(asked):
        d = np.bitwise_count((own ^ a).view(np.uint64))
        first = np.lexsort((ids, d))[:11]
        assert (distance[row == i] == d[first]).all() and (found[row == i] == ids[first]).all()


def test_sign_codes(spark):
    vectors = [[1.0] + [-1.0] * 62 + [0.5], [None, 2.0], [], None, [0.0] * 64]
    got = spark.createDataFrame([(v,) for v in vectors], T.StructType([T.StructField("e", T.ArrayType(T.DoubleType()))])).select(hamming_search.sign_code("e")).collect()
    assert [r[0] for r in got] == [1 - 2**63, 2, 0, None, 0]


def test_empty_tables(spark):
    none = pages(spark, [])
    assert warc.archive_round_trip(none).count() == url_filter.judged(none).count() == 0
    codes = spark.createDataFrame([], "id long, code long")
    assert hamming_search.top_k(codes, codes).count() == 0
    one = spark.createDataFrame([(1, 5)], "id long, code long")
    assert [r["neighbours"] for r in hamming_search.top_k(codes, one).collect()] == [[]]


# ---- statements -----------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{SF_DIR}/{file}'")
    df = QUERIES[name](spark, SF_DIR)
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert collections.Counter(tuple(r) for r in df.select(*columns).collect()) == collections.Counter(result.fetchall())
