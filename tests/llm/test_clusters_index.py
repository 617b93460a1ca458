"""Clustering with drift bounds and the multi-index search against brute force."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardmart.llm import drift_clusters as dc
from wardmart.llm import multi_index as mi
from wardmart.llm import queries

ODD = [None, [], [0.0] * 6, [1.0, None, 2.0, 1.0, 1.0, 1.0], [1.0, float("nan"), 2.0, 0.0, 0.0, 0.0],
       [1.0, float("inf"), 0.0, 0.0, 0.0, 0.0], [1.0, 2.0], [3.0] * 7]


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr(
        "*", "'x' as whole", "'y' as cluster", "'z' as row", "1 as label", "2 as rank").repartition(4)


def blobs(n=300, dim=6, groups=5, seed=0, spread=0.3):
    r = np.random.default_rng(seed)
    middle = 4 * r.normal(size=(groups, dim))
    return [(i, [float(x) for x in middle[i % groups] + spread * r.normal(size=dim)]) for i in range(n)]


def clustered(rows, k, rounds, scale, dim, seed=1):
    """Lloyd's rounds in Python's integers."""
    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    mark = {i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() for i, _ in kept if i is not None}
    at = [v for _, v in sorted(kept, key=lambda x: (x[0] is None, mark.get(x[0], ""), x[1]))[:k]]

    def apart(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [min(range(len(at)), key=lambda c: (apart(v, at[c]), c)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for c in set(own):
            its = [v for (_, v), o in zip(kept, own) if o == c]
            at[c] = tuple(sum(x) // len(its) for x in zip(*its))
    own = assign()
    d = [apart(v, at[c]) for (_, v), c in zip(kept, own)]
    sums = {c: sum(x for x, o in zip(d, own) if o == c) for c in set(own)}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted(((i, c, x, sums[c], sum(d), sha[c]) for (i, _), c, x in zip(kept, own, d)), key=str)


@pytest.mark.parametrize("rows, k", [
    (blobs(), 8),
    (blobs(40, spread=3.0) + [(100 + i, v) for i, v in enumerate(ODD)], 4),
    (blobs(7), 16),                                                     # fewer vectors than centroids
    ([(i, [1.0] * 6) for i in range(30)] + [(3, [1.0] * 6)] * 5 + blobs(20), 6),   # equal centroids, repeated rows
    ([(None, [float(i)] * 6) for i in range(3)] + blobs(10), 2),
])
def test_clusters(spark, rows, k):
    found = dc.clusters(frame(spark, rows), k, 3, 64, 6)
    assert sorted(map(tuple, found.collect()), key=str) == clustered(rows, k, 3, 64, 6)


def test_clusters_of_large_components(spark):
    """Beyond 2**53 all is done in Python's integers; distances stop at 64 bits."""
    rows = [(i, [x * 1e12 for x in v]) for i, v in blobs(30)]
    found = {r.vec_id: r for r in dc.clusters(frame(spark, rows), 4, 3, 64, 6).collect()}
    for i, c, d, own, whole, sha in clustered(rows, 4, 3, 64, 6):
        r = found[i]
        assert (r.cluster, r.centroid_sha256) == (c, sha)
        assert (r.distance, r.cluster_inertia) == (min(d, dc.LARGEST), min(r.cluster_inertia, dc.LARGEST))


def test_clusters_of_an_empty_table(spark):
    found = dc.clusters(frame(spark, [(1, None)]), 4, 3, 64, 6)
    assert found.count() == 0
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_nearing_bounds_every_point_of_the_sphere():
    """Never less than what random points of the sphere show, and often less than the drift."""
    r = np.random.default_rng(5)
    below = 0
    for _ in range(300):
        dim = int(r.integers(1, 6))
        centre, old = 5 * r.normal(size=dim), 5 * r.normal(size=dim)
        new = old + r.normal(size=dim) * r.choice([0.0, 0.1, 3.0])
        radius, drift = float(r.choice([0.0, 0.5, 4.0])), float(np.linalg.norm(new - old))
        bound = dc.nearing(centre, radius, old, new, drift)
        way = r.normal(size=(2000, dim))
        points = centre + radius * way / np.linalg.norm(way, axis=1, keepdims=True) * r.random((2000, 1)) ** (1 / dim)
        closer = np.linalg.norm(points - old, axis=1) - np.linalg.norm(points - new, axis=1)
        assert closer.max() <= bound + 1e-9
        assert 0 <= bound <= drift + 1e-12
        below += bound < 0.9 * drift
    assert below > 100


def test_bounds_hold_and_save_scans(spark):
    """After every round both bounds enclose the distances, and few vectors are ambiguous."""
    rows = dc.whole_vectors(frame(spark, blobs(600)), 64, 6)
    at = dc.start(rows, 8, 1)
    state = dc._assigned(rows, at)
    scanned = []
    for _ in range(4):
        new, radius = dc._means(state, at)
        drift = dc.Drift.between(at, new, radius)
        assert (drift.loosened <= drift.moved.max() + 1e-9).all()
        state, at = dc._assigned(state, new, drift), new
        got = state.collect()
        d = np.sqrt(at.distances(np.array([r.whole for r in got])))
        own = np.array([r.cluster for r in got])
        assert (own == d.argmin(axis=1)).all()
        mine = d[np.arange(len(got)), own]
        d[np.arange(len(got)), own] = np.inf
        assert (np.array([r.upper for r in got]) >= mine * (1 - 1e-12)).all()
        assert (np.array([r.lower for r in got]) <= d.min(axis=1) * (1 + 1e-12)).all()
        scanned.append(sum(r.scanned for r in got))
    assert scanned[-1] < 100


def nearest(rows, asks, k):
    """Exact answers: (query, rank) -> (vec_id, distance)."""
    good = [(i, np.array(v)) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q in sorted({i for i, _ in good if asks(i)}):
        best = {}
        for i, v in good:
            if i != q:
                d = min((math.sqrt(((a - v) ** 2).sum()) for j, a in good if j == q and len(a) == len(v)), default=None)
                if d is not None:
                    best[i] = min(d, best.get(i, math.inf))
        for rank, (i, d) in enumerate(sorted(best.items(), key=lambda x: (x[1], x[0]))[:k], 1):
            out[q, rank] = (i, d)
    return out


def searched(spark, rows, k=10, every=10):
    found = mi.search(frame(spark, rows), F.pmod("vec_id", F.lit(every)) == 0, k).collect()
    out = {(r.query_id, r.rank): (r.vec_id, r.score) for r in found}
    assert len(out) == len(found)
    return out


def recall(found, truth):
    hits = sum(1 for key in {(q, i) for (q, _), (i, _) in found.items()} & {(q, i) for (q, _), (i, _) in truth.items()})
    return hits / len(truth)


def test_walk_is_in_order():
    r = np.random.default_rng(2)
    a, b = r.random(7), r.random(5)
    walked = list(mi.cells_by_distance(a, b))
    sums = [a[x] + b[y] for x, y in walked]
    assert sums == sorted(sums) and len(set(walked)) == 35


def test_search_on_blobs_sees_few(spark):
    rows = blobs(3000, dim=16, groups=40)
    data = frame(spark, rows)
    truth = nearest(rows, lambda i: i % 100 == 0, 10)
    found = searched(spark, rows, every=100)
    assert recall(found, truth) >= 0.9
    assert all(score == pytest.approx(math.dist(rows[q][1], rows[i][1]), abs=1e-12) for (q, _), (i, score) in found.items())
    plain = data.select("vec_id", F.size("embedding").alias("dim"), "embedding")
    index = mi.fit(plain, 3000, 16)
    table = mi.indexed(plain, index)
    assert index[16].sizes.sum() == 3000 and (index[16].sizes > 0).sum() > 30
    assert mi.depth(index, table, plain.limit(50).collect(), 10) < 0.3


@pytest.mark.parametrize("entries, asking", [(8192, 1024), (16, 3)])
def test_search_with_odd_rows(spark, monkeypatch, entries, asking):
    """Copies of one vector, repeated ids, odd and short vectors, groups that are dealt into slots."""
    monkeypatch.setattr(mi, "ENTRIES", entries)
    monkeypatch.setattr(mi, "ASKING", asking)
    rows = blobs(120) + [(200 + i, [1.0] * 6) for i in range(90)] + [(5, blobs(6)[5][1])] * 30
    rows += [(1000 + 10 * i, v) for i, v in enumerate(ODD)] + [(None, [1.0] * 6), (2000, [1.0, 2.0]), (2001, [1.0, 2.5])]
    truth = nearest(rows, lambda i: i % 10 == 0, 10)
    found = searched(spark, rows)
    assert recall(found, truth) >= 0.9
    assert {q: n for q, n in found if n == 1}.keys() == {q: n for q, n in truth if n == 1}.keys()
    for q in (200, 210, 280):  # among equal ones the smallest ids
        assert [found[q, r] for r in range(1, 11)] == [truth[q, r] for r in range(1, 11)]
    assert found[1060, 1][0] == 2000 and found[2000, 1] == (1060, 0.0)


def test_repeated_ids_do_not_crowd_out_others(spark):
    rows = [(0, [1.0, 0.0, 0.0, 0.0])] + [(1, [1.0, 0.1, 0.0, 0.0])] * 400 + [
        (i, [float(x) for x in np.random.default_rng(i).normal(size=4)]) for i in range(2, 60)]
    found, truth = searched(spark, rows, every=1000), nearest(rows, lambda i: i == 0, 10)
    assert sum(1 for q, _ in found if q == 0) == 10
    assert found[0, 1][0] == 1 == truth[0, 1][0]


def test_small_tables(spark):
    rows = blobs(5)
    found, truth = searched(spark, rows, every=1), nearest(rows, lambda i: True, 10)
    assert {at: i for at, (i, _) in found.items()} == {at: i for at, (i, _) in truth.items()}
    assert searched(spark, [(1, None)]) == {}
    assert searched(spark, blobs(5)[1:]) == {}  # no queries
    assert mi.search(frame(spark, []), F.lit(True)).columns == ["query_id", "rank", "vec_id", "score"]


def test_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    truth = nearest(rows, lambda i: i % 100 == 0, 10)
    found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in queries.QUERIES["op13_nearest"](spark, sf).collect()}
    assert len(found) == len(truth) == 200
    assert recall(found, truth) >= 0.9
