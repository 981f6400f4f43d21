"""Near-duplicate vectors against all pairs, on clusters, odd vectors and a small table."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starfeed.llm import embedding_dedup as ed
from starfeed.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, key string, rid long, vector string, root string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, "v", "r") for r in rows], SCHEMA)


def brute(rows, threshold=0.9):
    """Per row: (id, links, component, kept)."""
    good = [v if v and all(x is not None and math.isfinite(x) for x in v) and any(v) else None for _, v in rows]
    units = [None if v is None else np.asarray(v) / np.abs(v).max() for v in good]
    units = [None if u is None else u / np.sqrt((u * u).sum()) for u in units]
    label, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    by_size = collections.defaultdict(list)
    for i, u in enumerate(units):
        if u is not None:
            by_size[len(u)].append(i)
    for at in by_size.values():
        close = np.asarray([units[i] for i in at])
        for a, b in np.argwhere(close @ close.T >= threshold):
            if a != b:
                links[at[a]] += 1
                label[root(at[a])] = root(at[b])
    least = {}
    for i, (vec_id, _) in enumerate(rows):
        ids = [x for x in (least.get(root(i)), vec_id) if x is not None]
        least[root(i)] = min(ids) if ids else None
    return collections.Counter((v, links[i], least[root(i)], v is not None and v == least[root(i)]) for i, (v, _) in enumerate(rows))


def found(spark, rows, **options):
    return collections.Counter(tuple(r) for r in ed.near_duplicates(frame(spark, rows), **options).collect())


def clusters(rng, dim, sizes, noise, ids=0):
    rows = []
    for n in sizes:
        centre = rng.normal(size=dim)
        for _ in range(n):
            rows.append((ids + len(rows), (centre + noise * np.linalg.norm(centre) / math.sqrt(dim) * rng.normal(size=dim)).tolist()))
    return rows


@pytest.mark.parametrize("dim, noise", [(64, 0.1), (64, 0.3), (64, 0.45), (20, 0.3), (3, 0.05), (200, 0.4)])
def test_clusters_equal_all_pairs(spark, dim, noise):
    rng = np.random.default_rng(dim)
    rows = clusters(rng, dim, [1] * 60 + [2] * 20 + [5, 9, 40], noise)
    assert found(spark, rows) == brute(rows)


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(ed, "BLOCK", 7)
    rng = np.random.default_rng(5)
    rows = clusters(rng, 32, [60, 30, 1, 1, 1], 0.2) + clusters(rng, 32, [80], 0.42, 1000)
    rows += [(5000 + i, rows[0][1]) for i in range(40)]
    assert found(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    one, two = [1.0, 0.0, 0.5, 0.0], [0.0, 1.0, 0.0, 0.0]
    rows = [
        (1, one), (2, one), (2, one), (3, [2 * x for x in one]), (4, [-x for x in one]), (5, two), (None, two), (6, None), (7, []), (8, [0.0] * 4),
        (9, [1.0, None, 0.5, 0.0]), (10, [math.nan, 0.0, 0.0, 0.0]), (11, [math.inf, 1.0, 0.0, 0.0]), (12, [1.0]), (13, [3.0]), (14, [1e200, 0.0, 5e199, 0.0]),
        (15, [1e-200, 0.0, 5e-201, 0.0]), (None, [9.0, 9.0, 9.0, -9.0]), (None, None), (16, one + [0.0]), (16, two),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == {}


def test_vectors_of_one_direction_are_no_group(spark, monkeypatch):
    """All cosines lie about 0.8, so that buckets are full and sketches near; groups hold linked vectors alone."""
    rng = np.random.default_rng(17)
    rows = clusters(rng, 64, [700], 0.5) + [(1000 + i, v) for i, (_, v) in enumerate(clusters(rng, 64, [3] * 30, 0.1))]
    sizes, written = [], ed.written

    def noted(df, label):
        out = written(df, label)
        if label == "groups":
            sizes.append(out.groupBy("root").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(ed, "written", noted)
    expected = brute(rows)
    assert found(spark, rows) == expected
    largest = max(collections.Counter(component for _, _, component, _ in expected.elements()).values())
    assert sizes == [largest] and largest < 100


def test_pairs_at_the_threshold_are_found(spark):
    """A thousand pairs that have nothing but each other, just above the threshold."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(1000):
        a, b = rng.normal(size=(2, 64))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        cosine = 0.901 if i % 2 else 0.899
        rows += [(2 * i, a.tolist()), (2 * i + 1, (cosine * a + math.sqrt(1 - cosine**2) * b).tolist())]
    got = {r[0]: r for r in ed.near_duplicates(frame(spark, rows)).collect()}
    assert sum(got[2 * i + 1]["component_id"] == 2 * i for i in range(1, 1000, 2)) >= 497
    assert all(got[2 * i]["n_links"] == 0 for i in range(0, 1000, 2))


def test_rotations_keep_lengths_and_meet_the_recall():
    x = np.random.default_rng(1).normal(size=(50, 64)).astype(np.float32)
    assert np.allclose(ed.hadamard(ed.hadamard(x)), x, atol=1e-4)
    assert np.allclose((ed.rotated(x, 3) ** 2).sum(1), (x**2).sum(1), rtol=1e-4)
    assert [ed.plan(64, n, 0.9, 0.999)[0] for n in (10, 1000, 10**5, 10**9)] == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        ed.plan(64, 10**9, 0.05, 0.999, 100)
    assert (ed.buckets_of(ed.padded(x), 0, 2, 4)[:, 0] == ed.buckets_of(ed.padded(x), 0, 2, 1)[:, 0]).all()


def test_query_on_a_table_with_a_large_cluster(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = clusters(rng, 64, [600] + [1] * 900 + [30] * 4, 0.15)
    frame(spark, rows).select("vec_id", F.col("embedding").cast("array<float>"), F.lit(1).alias("label")).write.parquet(f"{tmp_path}/embeddings.parquet")
    single = [(i, np.float32(v).astype(float).tolist()) for i, v in rows]
    assert collections.Counter(tuple(r) for r in QUERIES["op12_cross_polytope"](spark, str(tmp_path)).collect()) == brute(single)
