"""Vector and chat operators against brute force and SQL."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest

from wardmart.llm import chat, near_vectors, queries, topk
from wardmart.llm.components import components

SF = "/root/testdata/sf0.001"
ODD = [None, [], [0.0, 0.0, 0.0], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [1.0, float("inf"), 0.0], [1.0, 2.0]]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "'x' as rank", "'y' as node", "'z' as size", "1 as label").repartition(3)


def copies(seed=0):
    """Random vectors, a group of equal ones, groups of near ones, odd ones."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(60, 24))
    rows = [base[i] for i in range(60)] + [base[3]] * 40
    rows += [base[5] + 0.06 * rng.normal(size=24) for _ in range(150)]
    rows += [base[7] * (1 + i) for i in range(5)]
    out = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    return out + [(1000 + i, v) for i, v in enumerate(ODD)]


def usable(v, zero=True):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and (not zero or any(v))


def near_truth(rows):
    good = {i: np.array(v) for i, v in rows if usable(v)}
    links = {i: set() for i, _ in rows}
    for a, b in itertools.combinations(good, 2):
        if len(good[a]) == len(good[b]):
            cosine = good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b])
            if cosine >= 0.95:
                links[a].add(b)
                links[b].add(a)
    component = {}
    for i in sorted(links):
        if i not in component:
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in component:
                    component[x] = i
                    todo += links[x]
    return {i: (len(links[i]), component[i], component[i] == i) for i in links}


@pytest.mark.parametrize("tile", [1024, 17])
def test_near_vectors(spark, monkeypatch, tile):
    monkeypatch.setattr(near_vectors, "TILE", tile)
    rows = copies()
    found = near_vectors.near_duplicates(vectors(spark, rows)).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == near_truth(rows)
    assert len(found) == len(rows)


def test_near_vectors_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    truth = near_truth(rows)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in queries.QUERIES["op8_near_vectors"](spark, sf).collect()}
    assert set(found) == set(truth)
    assert sum(n for n, *_ in found.values()) >= 0.9 * sum(n for n, *_ in truth.values())
    assert all(found[i][0] <= truth[i][0] for i in truth)


def planted(n, group, seed=4, pairs=500, dim=64):
    """``n`` random unit vectors, a third of them at about cosine ``group`` to each other (0: none),
    and among that third pairs at 0.955."""
    rng = np.random.default_rng(seed)

    def units(x):
        return x / np.linalg.norm(x, axis=-1, keepdims=True)

    out = units(rng.normal(size=(n, dim)))
    third = n // 3
    out[:third] = units(math.sqrt(group) * units(rng.normal(size=dim)) + math.sqrt(1 - group) * out[:third])
    for i in range(0, 2 * pairs, 2):
        away = rng.normal(size=dim)
        away = units(away - (away @ out[i]) * out[i])
        out[i + 1] = 0.955 * out[i] + math.sqrt(1 - 0.955 ** 2) * away
    return out


def linked_truth(units):
    """All pairs at the threshold or above, by brute force."""
    out = []
    for at in range(0, len(units), 1000):
        a, b = np.nonzero(units[at:at + 1000] @ units.T >= 0.95)
        out += [(int(x) + at, int(y)) for x, y in zip(a, b) if x + at < y]
    return out


def recall(spark, units, least=500):
    """Share of the true pairs whose two sides are in one component of the links."""
    rows = [(i, 64, [float(x) for x in v]) for i, v in enumerate(units)]
    nodes = spark.createDataFrame(rows, "node long, dim int, embedding array<double>").repartition(8)
    component = {r.node: r.component for r in components(near_vectors.window_links(nodes, len(rows))).collect()}
    truth = linked_truth(units)
    assert len(truth) >= least
    return sum(component.get(a, -1) == component.get(b, -2) for a, b in truth) / len(truth)


def test_near_vectors_dense_group(spark):
    assert recall(spark, planted(20_000, 0.9)) >= 0.998


def test_near_vectors_dense_group_by_passes(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "WINDOW", 64)
    monkeypatch.setattr(near_vectors, "LEAST_PASSES", 0)
    monkeypatch.setattr(near_vectors, "all_links", lambda nodes, n: nodes.selectExpr("node a", "node b").where("false"))
    assert recall(spark, planted(6_000, 0.8)) >= 0.98


@pytest.mark.parametrize("n, group, pairs", [
    (500, 0.0, 100), (500, 0.9, 60), (2_000, 0.0, 300), (2_000, 0.9, 300), (50_000, 0.0, 500), (50_000, 0.9, 500)])
def test_near_vectors_by_passes_at_every_size(spark, monkeypatch, n, group, pairs):
    """The passes find the pairs alone, without any comparison of all with all."""
    monkeypatch.setattr(near_vectors, "all_links", lambda nodes, n: nodes.selectExpr("node a", "node b").where("false"))
    assert recall(spark, planted(n, group, pairs=pairs), pairs) >= 0.9


def test_repeated_ids(spark):
    """Unlike vectors of one id keep their links; equal rows are one vector."""
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    near = [1.0, 0.01, 0.0]
    rows = [(1, a), (1, b), (3, near), (4, b), (5, [0.0, 0.0, 1.0]), (5, [0.0, 0.0, 1.0])]
    found = sorted((r.vec_id, r.n_links, r.component_id, r.kept)
                   for r in near_vectors.near_duplicates(vectors(spark, rows)).collect())
    assert found == [(1, 1, 1, True), (1, 1, 1, True), (3, 1, 1, False), (4, 1, 1, False),
                     (5, 0, 5, True), (5, 0, 5, True)]
    both = [(7, a), (7, near), (8, a)]
    found = sorted((r.vec_id, r.n_links, r.component_id) for r in near_vectors.near_duplicates(vectors(spark, both)).collect())
    assert found == [(7, 2, 7), (7, 2, 7), (8, 2, 7)]


def test_near_vectors_evenly_spread(spark):
    assert recall(spark, planted(20_000, 0.0)) >= 0.998


def test_near_vectors_counts_of_planted_pairs(spark):
    """The whole operator against brute force where there is something to find."""
    units = planted(3_000, 0.8, pairs=100)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(units)]
    links = np.zeros(len(units), np.int64)
    truth = linked_truth(units)
    assert len(truth) >= 100
    for a, b in truth:
        links[[a, b]] += 1
    found = {r.vec_id: r.n_links for r in near_vectors.near_duplicates(vectors(spark, rows)).collect()}
    assert [found[i] for i in range(len(units))] == links.tolist()


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_vectors.near_duplicates(none).count() == 0
    assert topk.top(none, queries.F.col("vec_id") >= 0).count() == 0


def top_truth(rows, is_query, k):
    ints = {i: [math.floor(256 * x) for x in v] for i, v in rows if usable(v, zero=False)}
    out = []
    for q in ints:
        if is_query(q):
            scores = [(-sum(a * b for a, b in zip(ints[q], ints[c])), c) for c in ints
                      if c != q and len(ints[c]) == len(ints[q])]
            out += [(q, n, c, -s) for n, (s, c) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(8192, 8192, 2048, 64), (20, 7, 3, 2)])
def test_top(spark, monkeypatch, sizes):
    for name, size in zip(("CANDIDATES", "QUERIES", "COLUMNS", "FAN"), sizes):
        monkeypatch.setattr(topk, name, size)
    rows = copies(1) + [(2000, [1e15] * 24), (2001, [float(i) * 1e6 for i in range(24)])]
    found = topk.top(vectors(spark, rows), queries.F.pmod("vec_id", queries.F.lit(7)) == 0, 5)
    expected = top_truth(rows, lambda i: i % 7 == 0, 5)
    limit = 2 ** 63 - 1
    expected = [(q, n, c, s) for q, n, c, s in expected if abs(s) <= limit]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect() if abs(r.score) < limit) == expected


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, x) for x in range(501, 560)] + [(7, 7)]
    links += [(rng.randrange(1000, 1300), rng.randrange(1000, 1300)) for _ in range(150)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    up = {x: x for p in links for x in p}
    for _ in range(400):
        for a, b in links:
            up[a] = up[b] = min(up[a], up[b])
    assert found == {x: c for x, c in up.items() if x != 7}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Chat

def chat_truth(rows):
    def low(x):
        return (x is not None, x if x is not None else "")
    logs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            logs.setdefault(conv, []).append((turn, role, text))
    for turns in logs.values():
        turns.sort(key=lambda t: ((t[0] is not None, t[0] or 0), low(t[1]), low(t[2])))
    body = {c: [t[1:] for t in turns] for c, turns in logs.items()}
    out = []
    for c, turns in logs.items():
        if any(d != c and body[d][:len(body[c])] == body[c] and (len(body[d]), c) > (len(body[c]), d) for d in logs):
            continue
        at = 0
        for place, (turn, role, text) in enumerate(turns, 1):
            shown = f"<|im_start|>{role or ''}\n{text or ''}<|im_end|>\n"
            out.append((c, place, turn, role, shown, at))
            at += len(shown)
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1024, 3])
def test_chat(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    rng = random.Random(3)
    rows = []
    for c in range(60):
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["a", "b", "é"])) for t in range(rng.randint(1, 7))]
    rows += [(100, t, "user", f"x{t}") for t in range(30)] + [(101, 2 * t, "user", f"x{t}") for t in range(20)]
    rows += [(102, 0, None, None), (103, 0, "", ""), (104, None, "user", "x0"), (104, None, "user", "x0"), (None, 1, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "'q' as at", "'q' as block", "'q' as h", "'q' as size")
    found = [tuple(r) for r in chat.formatted(df).collect()]
    assert sorted(found, key=str) == chat_truth(rows)
    assert chat.formatted(df.where("false")).count() == 0


def test_chat_runs_no_python(spark):
    plan = chat.formatted(spark.read.parquet(f"{SF}/conversations.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
