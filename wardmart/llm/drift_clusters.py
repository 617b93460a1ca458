"""Clustering around centroids, with bounds that geometry loosens less than the whole drift.

Vectors become whole numbers, so that distances, ties and means are exact. Every vector keeps
its cluster, an upper bound on the distance to its centroid and a lower bound on that to any
other one. When centroids move, the vectors of a cluster lie in a sphere around its old
centroid. Seen from the middle between the old and the new place of another centroid, the
sphere fills a range of angles against the direction of the move; in the plane of the three
centroids, no vector of the sphere comes closer by more than the drift times the cosine of the
least such angle. That, and not the whole drift, is taken off its lower bound. A vector whose
upper bound stays below its lower bound keeps its cluster; of the others the upper bound is
measured anew, and those still ambiguous are compared exactly with all centroids.

Vectors take part if they have exactly ``dim`` components, none null or non-finite; others give
no row. Repeated rows are rows of their own; a null vec_id is kept and never starts a centroid
before a known one. Ties go to the smaller number, equal centroids included. With fewer vectors
than centroids there are as many centroids as vectors. An empty table gives no rows. Components
whose multiple is no double stop at the largest one; distances and sums past 64 bits stop at
the largest long. Other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmart.llm.common import written
from wardmart.llm.vectors import finite, matrix

#: Groups that the sums of tasks are merged in before the driver adds up one row per group and cluster.
MERGES = 64
#: Relative room for rounding in bounds, which are doubles, and in cosines.
SLACK, COSINE_SLACK = 1e-9, 1e-6
LARGEST = 2 ** 63 - 1


def _exact_in_doubles(values: np.ndarray, centroids: np.ndarray) -> bool:
    most = np.abs(values).max(initial=0) + np.abs(centroids).max(initial=0)
    return bool(4 * values.shape[1] * most * most < 2 ** 53)


def _whole(values: np.ndarray) -> np.ndarray:
    """The same numbers as Python's integers."""
    return np.array([[int(x) for x in row] for row in values], object).reshape(values.shape)


@dataclass(frozen=True)
class Centroids:
    """Whole-number centroids, as rows of Python's integers and as doubles."""

    rows: tuple[tuple[int, ...], ...]

    @property
    def doubles(self) -> np.ndarray:
        return np.array(self.rows, np.float64).reshape(len(self.rows), -1)

    def distances(self, values: np.ndarray, cluster: np.ndarray | None = None) -> np.ndarray:
        """Exact squared distances of all values to all centroids, or to that of ``cluster``."""
        at = self.doubles
        if _exact_in_doubles(values, at):
            if cluster is not None:
                return ((values - at[cluster]) ** 2).sum(axis=1)
            return (values ** 2).sum(axis=1)[:, None] - 2 * (values @ at.T) + (at ** 2).sum(axis=1)
        values, at = _whole(values), np.array(self.rows, object).reshape(at.shape)
        if cluster is not None:
            return ((values - at[cluster]) ** 2).sum(axis=1)
        return np.stack([((values - c) ** 2).sum(axis=1) for c in at], axis=1)

    def sha256(self, number: int) -> str:
        return hashlib.sha256(",".join(map(str, self.rows[number])).encode()).hexdigest()


def _bounds(squares: np.ndarray, sign: int) -> np.ndarray:
    """Distances as doubles that are never too low (sign 1) or too high (-1)."""
    if squares.dtype == object:  # may be beyond doubles: a bound that decides nothing
        return np.full(len(squares), math.inf if sign > 0 else 0.0)
    return np.sqrt(squares) * (1 + sign * SLACK)


@dataclass(frozen=True)
class Drift:
    """What a move of the centroids does to the bounds of a cluster's vectors."""

    moved: np.ndarray
    loosened: np.ndarray

    @classmethod
    def between(cls, old: Centroids, new: Centroids, radius: np.ndarray) -> Drift:
        a, b = old.doubles, new.doubles
        with np.errstate(all="ignore"):
            drift = np.linalg.norm(b - a, axis=1) * (1 + SLACK)
            drift = np.where(np.isnan(drift), math.inf, drift)
            loosened = np.array([max((
                nearing(a[i], radius[i], a[j], b[j], drift[j]) for j in range(len(a)) if j != i), default=0.0)
                for i in range(len(a))])
        return cls(drift, loosened)


def nearing(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray, drift: float) -> float:
    """How much closer a move from ``old`` to ``new`` can come to a point of a sphere, at most.

    With m the middle of the move and p the point seen from m, the distances to both places add
    up to at least 2|p|, and their squares differ by 2 * drift * |p| * cos(angle); so the
    distances differ by drift * cos(angle) at most.
    """
    if not 0 < drift < math.inf:
        return drift
    seen = centre - (old + new) / 2
    away = float(np.linalg.norm(seen))
    if not radius * (1 + SLACK) < away < math.inf:
        return drift
    cosine = float(seen @ (new - old)) / (away * float(np.linalg.norm(new - old)))
    angle = math.acos(min(1.0, max(-1.0, cosine))) - math.asin(radius / away)
    return drift * min(1.0, max(0.0, math.cos(max(0.0, angle)) + COSINE_SLACK))


def _scanned(values: np.ndarray, centroids: Centroids):
    """Cluster, upper and lower bound of every value, from all its distances."""
    squares = centroids.distances(values)
    cluster = squares.argmin(axis=1).astype(np.int32)
    in_order = np.sort(squares, axis=1)
    lower = _bounds(in_order[:, 1], -1) if squares.shape[1] > 1 else np.full(len(values), math.inf)
    return cluster, _bounds(in_order[:, 0], 1), lower


def _moved(values, cluster, upper, lower, centroids: Centroids, drift: Drift):
    """The same after a move, and which values were compared with all centroids."""
    upper, lower = upper + drift.moved[cluster], lower - drift.loosened[cluster]
    near = np.flatnonzero(~(upper < lower))
    upper[near] = _bounds(centroids.distances(values[near], cluster[near]), 1)
    near = near[~(upper[near] < lower[near])]
    cluster[near], upper[near], lower[near] = _scanned(values[near], centroids)
    scanned = np.zeros(len(values), bool)
    scanned[near] = True
    return cluster, upper, lower, scanned


_STATE = "whole array<double>, cluster int, upper double, lower double, scanned boolean"
_NAMES = ["vec_id", "whole", "cluster", "upper", "lower", "scanned"]


def _assigned(rows: DataFrame, centroids: Centroids, drift: Drift | None = None) -> DataFrame:
    """Rows with their cluster; without ``drift`` all are compared with all centroids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = matrix(batch.column("whole"))
            if drift is None:
                found = (*_scanned(values, centroids), np.ones(len(values), bool))
            else:
                state = (np.array(batch.column(c).to_numpy()) for c in ("cluster", "upper", "lower"))
                found = _moved(values, *state, centroids, drift)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("whole"), *map(pa.array, found)], names=_NAMES)

    kind = rows.schema["vec_id"].dataType.simpleString()
    return written(rows.mapInArrow(run, f"vec_id {kind}, {_STATE}"), "clusters")


_SUMS = "cluster int, part int, n long, radius double, sums array<string>"


def _sums(k: int, dim: int):
    """Rows per cluster of one task: how many vectors, their radius, and exact sums as text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dim), object)
        n, radius = np.zeros(k, np.int64), np.zeros(k)
        for batch in batches:
            values, cluster = matrix(batch.column("whole")), batch.column("cluster").to_numpy()
            if not len(values):
                continue
            n += np.bincount(cluster, minlength=k)
            np.maximum.at(radius, cluster, batch.column("upper").to_numpy())
            if np.abs(values).max() * len(values) < 2 ** 53:
                one = (cluster == np.arange(k)[:, None]).astype(np.float64)
                sums += (one @ values).astype(np.int64).astype(object)
            else:
                np.add.at(sums, cluster, _whole(values))
        some = np.flatnonzero(n)
        part = TaskContext.get().partitionId() % MERGES
        yield _sums_batch(some, part, n[some], radius[some], sums[some])
    return run


def _sums_batch(cluster, part, n, radius, sums) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(cluster, np.int32)), pa.array(np.full(len(cluster), part, np.int32)), pa.array(n),
         pa.array(radius), pa.array([list(map(str, row)) for row in sums], pa.list_(pa.string()))],
        names=["cluster", "part", "n", "radius", "sums"])


def _added(sums: list[list[str]]) -> list[int]:
    return [sum(map(int, column)) for column in zip(*sums)]


def _merge(table: pa.Table) -> pa.Table:
    first = [table.column(c)[0].as_py() for c in ("cluster", "part")]
    n, radius = (table.column(c).to_numpy() for c in ("n", "radius"))
    total = _added(table.column("sums").to_pylist())
    return pa.Table.from_batches([_sums_batch(
        [first[0]], first[1], n.sum(keepdims=True), radius.max(keepdims=True), [total])])


def _means(state: DataFrame, centroids: Centroids) -> tuple[Centroids, np.ndarray]:
    """Centroids at the floor of their vectors' mean, and the radius of every cluster."""
    k, dim = centroids.doubles.shape
    parts = state.select("whole", "cluster", "upper").mapInArrow(_sums(k, dim), _SUMS)
    found: dict[int, list] = {}
    for row in parts.groupBy("cluster", "part").applyInArrow(_merge, _SUMS).collect():  # MERGES * k rows at most
        found.setdefault(row.cluster, []).append(row)
    rows, radius = list(centroids.rows), np.zeros(k)
    for cluster, its in found.items():
        n = sum(r.n for r in its)
        rows[cluster] = tuple(x // n for x in _added([r.sums for r in its]))
        radius[cluster] = max(r.radius for r in its)
    return Centroids(tuple(rows)), radius


def start(rows: DataFrame, k: int, seed: int) -> Centroids:
    """The ``k`` vectors with the smallest sha256 of seed and id; equal ones by their components."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(mark.alias("mark"), "whole").orderBy(F.asc_nulls_last("mark"), "whole").limit(k).collect()
    return Centroids(tuple(tuple(map(int, r.whole)) for r in first))


def whole_vectors(vectors: DataFrame, scale: int, dim: int) -> DataFrame:
    """vec_id and floor(scale * x) of the vectors that take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.finfo(np.float64).max
        for batch in batches:
            if not batch.num_rows:
                continue
            with np.errstate(over="ignore"):
                values = np.clip(np.floor(scale * matrix(batch.column("embedding"))), -most, most)
            whole = pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * dim, values.ravel())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), whole], names=["vec_id", "whole"])

    kept = vectors.where(finite("embedding") & (F.size("embedding") == dim)).select("vec_id", "embedding")
    kind = kept.schema["vec_id"].dataType.simpleString()
    return written(kept.mapInArrow(run, f"vec_id {kind}, whole array<double>"), "whole")


def fit(rows: DataFrame, k: int, rounds: int, seed: int) -> tuple[DataFrame, Centroids]:
    """Final assignment of ``rows`` (vec_id, whole) and the final centroids."""
    centroids = start(rows, k, seed)
    if not centroids.rows:
        return rows.select("*", F.lit(0).alias("cluster")), centroids
    state = _assigned(rows, centroids)
    for _ in range(rounds):
        new, radius = _means(state, centroids)
        drift = Drift.between(centroids, new, radius)
        state, centroids = _assigned(state, new, drift), new
    return state, centroids


def clusters(vectors: DataFrame, k: int, rounds: int, scale: int, dim: int, seed: int = 1) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of ``vectors``
    (vec_id, embedding), after ``rounds`` moves of ``k`` centroids."""
    rows = whole_vectors(vectors, scale, dim)
    state, centroids = fit(rows, k, rounds, seed)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                squares = centroids.distances(matrix(batch.column("whole")), batch.column("cluster").to_numpy())
                squares = [min(int(x), LARGEST) for x in squares]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("cluster"), pa.array(squares, pa.int64())],
                    names=["vec_id", "cluster", "distance"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    found = written(state.select("vec_id", "whole", "cluster").mapInArrow(
        measure, f"vec_id {kind}, cluster int, distance long"), "distances")
    exact = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    sums = {r.cluster: int(r.total) for r in found.groupBy("cluster").agg(exact).collect()}  # k rows at most
    whole = min(sum(sums.values()), LARGEST)
    names = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    known = found.sparkSession.createDataFrame(
        [(c, min(n, LARGEST), whole, centroids.sha256(c)) for c, n in sums.items()], names)
    return found.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
