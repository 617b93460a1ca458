"""The quality model's parts against direct computation."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardmart.llm import quality, queries

SF = "/root/testdata/sf0.001"


def labelled(spark, sf=SF):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return quality.described(docs.repartition(5)), labels


def learned(spark, stats, labels):
    """Statistics, labels and folds of the training rows, as arrays."""
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(quality.FOLDS)).alias("fold")
    rows = stats.join(labels, "doc_id").select("stats", "quality", fold).collect()
    return (np.array([r.stats for r in rows]), np.array([r.quality for r in rows], float),
            np.array([r.fold for r in rows]))


def test_summed_equations_equal_a_direct_solve(spark):
    stats, labels = labelled(spark)
    x, y, fold = learned(spark, stats, labels)
    model = quality.fit(stats, labels)
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(1 / model.scale, np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1))
    features = model.features(x)
    ridge = quality.RIDGE * np.eye(quality.FEATURES)
    assert np.allclose(model.weights, np.linalg.solve(features.T @ features + ridge, features.T @ y), atol=1e-6)
    train = stats.join(labels, "doc_id").select(
        "stats", "quality", F.pmod(F.xxhash64("doc_id"), F.lit(quality.FOLDS)).alias("fold"))
    for f, part in enumerate(quality.equations(train, model)):
        mine = features[fold == f]
        assert np.allclose(part, mine.T @ np.column_stack([mine, y[fold == f]]))


def test_calibration_is_out_of_fold(spark):
    """The curve comes from scores of rows that the weights behind them do not know."""
    stats, labels = labelled(spark)
    x, y, fold = learned(spark, stats, labels)
    model = quality.fit(stats, labels)
    features = model.features(x)
    raw = np.zeros(len(y))
    for f in range(quality.FOLDS):
        others = features[fold != f]
        weights = np.linalg.solve(others.T @ others + quality.RIDGE * np.eye(quality.FEATURES), others.T @ y[fold != f])
        raw[fold == f] = features[fold == f] @ weights
    at = np.clip((raw + 0.25) / 1.5 * quality.BINS, 0, quality.BINS - 1).astype(int)
    bins = np.unique(at)
    assert np.allclose(model.knots, -0.25 + (bins + 0.5) * 1.5 / quality.BINS)
    n = np.array([(at == b).sum() for b in bins])
    good = np.array([y[at == b].mean() for b in bins])
    assert np.allclose(model.levels, closest_rising(good, n))


def closest_rising(values, weights):
    """The weighted isotonic fit by its definition: the largest of the smallest means."""
    def mean(i, j):
        return np.average(values[i:j + 1], weights=weights[i:j + 1])

    n = len(values)
    return [max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)]


@pytest.mark.parametrize("seed", range(5))
def test_isotonic(seed):
    rng = np.random.default_rng(seed)
    values, weights = rng.random(25).round(1), rng.integers(1, 5, 25).astype(float)
    assert quality.isotonic(values, weights).tolist() == pytest.approx(closest_rising(values, weights))


def test_features_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(1)
    dim = len(quality.STATISTICS)
    stats = rng.normal(size=(60, dim))
    width = quality.WIDTH * np.sqrt(dim)
    exact = np.exp(-((stats[:, None] - stats[None]) ** 2).sum(axis=2) / (2 * width ** 2))
    made = []
    for seed in range(40):
        waves = quality.Model(np.zeros(dim), np.ones(dim), seed).features(stats)[:, :-1]
        made.append(waves @ waves.T)
    assert np.abs(np.mean(made, axis=0) - exact).max() < 0.05  # unbiased
    assert np.abs(made[0] - exact).mean() < 0.1


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_every_size_takes_the_same_way(spark, sf, monkeypatch):
    """A fold's weights are solved and all labelled rows calibrate, however few they are."""
    calls = []
    real = quality.solved
    monkeypatch.setattr(quality, "solved", lambda normal: calls.append(1) or real(normal))
    stats, labels = labelled(spark, f"/root/testdata/{sf}")
    quality.fit(stats, labels)
    assert len(calls) == 1 + quality.FOLDS


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "c"), (4, "word " * 200_000)], "doc_id long, text string"
    ).selectExpr("*", "'x' as stats", "'y' as score", "'z' as quality", "1 as fold")
    labels = spark.createDataFrame(
        [(1, 0), (1, 1), (2, 0), (4, 0), (3, None), (None, 1), (77, 1)], "doc_id long, quality int")
    stats = quality.described(docs)
    found = quality.scored(stats, quality.fit(stats, labels)).collect()
    assert sorted((str(r.doc_id) for r in found)) == sorted(["1", "1", "2", "3", "None", "4"])
    assert all(0 <= r.score <= 1 for r in found)
    scores = {r.doc_id: r.score for r in found}
    assert len({r.score for r in found if r.doc_id == 1}) == 1 and scores[1] > scores[4]  # unlike labels count as 1


def test_empty_table(spark):
    stats = quality.described(spark.createDataFrame([], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert quality.scored(stats, quality.fit(stats, labels)).collect() == []


def test_query_columns(spark):
    found = queries.QUERIES["op2_quality"](spark, SF)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
