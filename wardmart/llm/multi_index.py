"""Approximate nearest neighbours by an inverted multi-index.

Both halves of a vector are quantised separately, each by its own list of centroids; a cell is
a pair of centroids, one of each half. A query walks through the cells in the order of its
summed distance to their two centroids, kept by a heap, until the cells hold the number of
vectors it is to see, and these are reranked by their exact distance.

Fitted on samples: the centroids, on at most ``SAMPLE`` vectors and ``SAMPLE_VALUES`` numbers,
and how deep the walk goes, on ``PROBES`` queries. These are compared with all vectors, and the
depth is the share of vectors that queries must see for ``RECALL`` of their true neighbours.
All vectors are indexed. Centroids grow with the root of the number of vectors, up to ``MOST``
a half: beyond that cells hold more, none are left out. Vectors of a length that the sample
lacks are one cell.

Cells with the same first centroid lie together in groups of bounded size; a larger group, such
as copies of one vector, is dealt into slots by row, and so are many queries of one group.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do
rows without a vec_id; vectors of unlike lengths do not meet. A query never finds a row of its
own id. Of rows with one id the nearest counts; a query that such rows leave with fewer than
``k`` results goes on through all cells. Ties go to the smaller id. An empty table, or one
without queries, gives no rows. Other columns of the table are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmart.llm.common import written
from wardmart.llm.vectors import finite, matrix

#: Vectors that the centroids are fitted on, and numbers in them.
SAMPLE, SAMPLE_VALUES = 16_384, 1 << 21
#: Queries that set the depth, and the share of true neighbours they must reach.
PROBES, RECALL = 100, 0.96
#: Vectors of a cell on average, and the fewest and most centroids of a half.
FILL, LEAST, MOST = 16, 8, 1024
#: Vectors and queries of a tile.
ENTRIES, ASKING = 8192, 1024
#: Columns of a matrix product, and pairs measured exactly, that are held at once.
COLUMNS, PAIRS = 2048, 16_384
ITERATIONS = 10


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)


def _centroids(values: np.ndarray, k: int) -> np.ndarray:
    """Lloyd's rounds from ``k`` different rows; a centroid that loses all rows stays."""
    at = np.sort(np.unique(values, axis=0, return_index=True)[1])[:k]
    found = values[at]
    for _ in range(ITERATIONS):
        nearest = _squares(values, found).argmin(axis=1)
        for c in np.unique(nearest):
            found[c] = values[nearest == c].mean(axis=0)
    return found


def halves(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = values.shape[1] // 2
    return values[:, :middle], values[:, middle:]


def cells_by_distance(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
    """All pairs of centroids by summed distance: a heap holds the next one of each row."""
    rows, columns = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    a, b = first[rows].tolist(), second[columns].tolist()
    heap = [(a[0] + b[0], 0, 0)]
    while heap:
        _, x, y = heapq.heappop(heap)
        yield rows[x], columns[y]
        if y + 1 < len(b):
            heapq.heappush(heap, (a[x] + b[y + 1], x, y + 1))
        if y == 0 and x + 1 < len(a):
            heapq.heappush(heap, (a[x + 1] + b[0], x + 1, 0))


@dataclass
class Codebook:
    """Centroids of both halves for vectors of one length; how many vectors each cell holds."""

    first: np.ndarray
    second: np.ndarray
    sizes: np.ndarray
    #: Second centroids whose cells make a group together.
    together: int = 1

    @property
    def shape(self) -> tuple[int, int]:
        return len(self.first), len(self.second)

    def distances(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(_squares(h, c) for h, c in zip(halves(values), (self.first, self.second)))

    def cells(self, values: np.ndarray) -> np.ndarray:
        a, b = (np.nan_to_num(d).argmin(axis=1) for d in self.distances(values))
        return a * self.shape[1] + b

    def groups(self, cells: np.ndarray) -> np.ndarray:
        a, b = np.divmod(cells, self.shape[1])
        return a * -(-self.shape[1] // self.together) + b // self.together

    def walk(self, value: np.ndarray, entries: int) -> np.ndarray:
        """The non-empty cells that a query visits until they hold ``entries`` vectors."""
        found, seen = [], 0
        a, b = self.distances(value[None, :])
        for x, y in cells_by_distance(np.nan_to_num(a[0]), np.nan_to_num(b[0])):
            size = self.sizes[x, y]
            if size:
                found.append(x * self.shape[1] + y)
                seen += size
                if seen >= entries:
                    break
        return np.array(found, np.int64)


Index = dict[int, Codebook]
#: What rows of other lengths fall into: one cell, one group.
_ONE_CELL = Codebook(np.zeros((1, 0)), np.zeros((1, 0)), np.ones((1, 1), np.int64))


def fit(rows: DataFrame, n: int, dim: int) -> Index:
    """Codebooks by length, for ``n`` rows of at most ``dim`` components."""
    most = max(1, min(SAMPLE, SAMPLE_VALUES // max(dim, 1)))
    sample = rows.select("embedding").orderBy(F.xxhash64("vec_id", "embedding"), "vec_id").limit(most).collect()
    by_length: dict[int, list] = {}
    for row in sample:
        by_length.setdefault(len(row.embedding), []).append(row.embedding)
    k = min(MOST, max(LEAST, math.isqrt(n // FILL)))
    together = max(1, min(k, ENTRIES * k * k // max(n, 1)))
    out = {}
    for length, its in by_length.items():
        values = np.array(its, np.float64)
        first, second = (_centroids(h, min(k, max(1, len(its) // 4))) for h in halves(values))
        out[length] = Codebook(first, second, np.zeros((len(first), len(second)), np.int64), together)
    return out


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims):
        part = batch.take(pa.array(np.flatnonzero(dims == dim)))
        yield int(dim), matrix(part.column("embedding")), part


def _book(index: Index, dim: int) -> Codebook:
    return index.get(dim, _ONE_CELL)


def _cells(index: Index, dim: int, values: np.ndarray) -> np.ndarray:
    return index[dim].cells(values) if dim in index else np.zeros(len(values), np.int64)


def indexed(rows: DataFrame, index: Index) -> DataFrame:
    """All rows (vec_id, dim, embedding) with a row number, their cell and group, as a table; the
    codebooks learn the sizes of their cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, values, part in _by_length(batch):
                cells = _cells(index, dim, values)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cells), pa.array(_book(index, dim).groups(cells))],
                    names=[*part.schema.names, "cell", "part"])

    kind = rows.schema["embedding"].dataType.simpleString()
    found = written(
        rows.mapInArrow(run, f"vec_id long, dim int, embedding {kind}, cell long, part long")
        .withColumn("row", F.monotonically_increasing_id()), "index")
    sizes = found.where(F.col("dim").isin(list(index))).groupBy("dim", "cell").agg(F.count("*").alias("n"))
    for row in sizes.collect():  # at most MOST * MOST rows a length of the sample
        index[row.dim].sizes.flat[row.cell] = row.n
    return found


def _best(query: np.ndarray, distance: np.ndarray, candidate: np.ndarray, k: int):
    """The ``k`` nearest of each query, each candidate once, nearest first."""
    order = np.lexsort((distance, candidate, query))
    query, distance, candidate = query[order], distance[order], candidate[order]
    new = np.ones(len(query), bool)
    new[1:] = (query[1:] != query[:-1]) | (candidate[1:] != candidate[:-1])
    query, distance, candidate = query[new], distance[new], candidate[new]
    order = np.lexsort((candidate, distance, query))
    query, distance, candidate = query[order], distance[order], candidate[order]
    new = np.ones(len(query), bool)
    new[1:] = query[1:] != query[:-1]
    place = np.arange(len(query)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    return query[place < k], distance[place < k], candidate[place < k]


def _nearest(asking: np.ndarray, values: np.ndarray, ids: np.ndarray, allowed, k: int):
    """Places of queries, exact distances and ids of their nearest among ``values``.

    ``allowed(low, high)`` says which of these columns each query may find. Products of
    matrices only rule out what is further than the k-th nearest by more than their rounding.
    """
    kept = (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64))
    rounding = 16 * max(asking.shape[1], 1) * np.finfo(np.float64).eps
    for low in range(0, len(ids), COLUMNS):
        part, its = values[low:low + COLUMNS], ids[low:low + COLUMNS]
        may = allowed(low, low + len(its))
        shown = np.where(may, np.nan_to_num(_squares(asking, part), nan=0.0), np.inf)
        with np.errstate(over="ignore"):
            room = rounding * ((asking * asking).sum(axis=1) + (part * part).sum(axis=1).max(initial=0))
        bounds = []
        for x in range(0, len(shown), 256):  # a k-th nearest different id: repeats of an id count once
            bounds.append(_kth(shown[x:x + 256], its, k))
        row, column = np.nonzero(may & ~(shown > (np.concatenate(bounds) + room)[:, None]))
        distance = np.empty(len(row))
        for at in range(0, len(row), PAIRS):
            some = slice(at, at + PAIRS)
            with np.errstate(over="ignore"):
                difference = asking[row[some]] - part[column[some]]
                distance[some] = np.sqrt((difference * difference).sum(axis=1))
        kept = _best(*(np.concatenate(x) for x in zip(kept, (row, distance, its[column]))), k)
    return kept


def _kth(shown: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Each row's k-th smallest over different ids; without so many, infinity."""
    names, first = np.unique(ids, return_inverse=True)
    if len(names) < len(ids):
        least = np.full((len(shown), len(names)), np.inf)
        np.minimum.at(least.T, first, shown.T)
        shown = least
    if shown.shape[1] < k:
        return np.full(len(shown), np.inf)
    return np.partition(shown, k - 1, axis=1)[:, k - 1]


def depth(index: Index, table: DataFrame, probes: list, k: int) -> float:
    """The share of vectors that the probes must see to meet ``RECALL`` of their ``k`` nearest,
    found by comparing them with all rows of ``table``."""
    by_length: dict[int, list] = {}
    for number, row in enumerate(probes):
        by_length.setdefault(len(row.embedding), []).append(number)
    asking = {dim: np.array([probes[i].embedding for i in its], np.float64) for dim, its in by_length.items()}
    own = np.array([row.vec_id for row in probes], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64))
        cells: dict[int, int] = {}
        for batch in batches:
            for dim, values, part in _by_length(batch):
                if dim not in asking:
                    continue
                its, ids = np.array(by_length[dim]), part.column("vec_id").to_numpy()
                row, distance, found = _nearest(
                    asking[dim], values, ids, lambda low, high, i=its, x=ids: own[i][:, None] != x[None, low:high], k)
                cells |= zip(ids.tolist(), part.column("cell").to_pylist())
                kept = _best(*(np.concatenate(x) for x in zip(kept, (its[row], distance, found))), k)
                cells = {i: cells[i] for i in kept[2].tolist()}
        yield pa.RecordBatch.from_arrays(
            [*map(pa.array, kept), pa.array([cells[i] for i in kept[2].tolist()], pa.int64())],
            names=["probe", "distance", "vec_id", "cell"])

    found = table.select("vec_id", "dim", "embedding", "cell").mapInArrow(
        run, "probe long, distance double, vec_id long, cell long")
    place = F.row_number().over(Window.partitionBy("probe").orderBy("distance", "vec_id"))
    shares = []
    for row in found.withColumn("place", place).where(F.col("place") <= k).collect():  # k rows a probe at most
        book = index.get(len(probes[row.probe].embedding))
        if book is not None:
            a, b = book.distances(np.array([probes[row.probe].embedding], np.float64))
            sums = np.nan_to_num(a[0])[:, None] + np.nan_to_num(b[0])[None, :]
            shares.append(book.sizes[sums <= sums.flat[row.cell]].sum() / book.sizes.sum())
    return sorted(shares)[math.ceil(RECALL * len(shares)) - 1] if shares else 1.0


def _asked(queries: DataFrame, index: Index, share: float, k: int) -> DataFrame:
    """One row for each query and group it visits, with the cells it visits there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, values, part in _by_length(batch):
                book = _book(index, dim)
                rows, groups, cells = [], [], []
                entries = max(k + 1, math.ceil(share * book.sizes.sum()))
                for row, value in enumerate(values):
                    visited = book.walk(value, entries) if dim in index else np.zeros(1, np.int64)
                    group = book.groups(visited)
                    order = np.argsort(group, kind="stable")
                    names, starts = np.unique(group[order], return_index=True)
                    rows += [row] * len(names)
                    groups += names.tolist()
                    cells += np.split(visited[order], starts[1:])
                out = part.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.array(groups, pa.int64()), pa.array(cells, pa.list_(pa.int64()))],
                    names=[*out.schema.names, "part", "cells"])

    kind = queries.schema["embedding"].dataType.simpleString()
    return written(
        queries.select("vec_id", "dim", "embedding")
        .mapInArrow(run, f"vec_id long, dim int, embedding {kind}, part long, cells array<long>")
        .withColumn("row", F.monotonically_increasing_id()), "asked")


def _rerank(k: int):
    def tile(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids, values = table.column("vec_id").to_numpy(), matrix(table.column("embedding"))
        cells = table.column("cells").combine_chunks()
        entries, queries = np.flatnonzero(~asks), np.flatnonzero(asks)
        if not len(entries) or not len(queries):  # a slot that no row was dealt into
            return pa.table({"query_id": ids[:0], "vec_id": ids[:0], "score": np.empty(0)})
        names, own = np.unique(cells.take(pa.array(entries)).flatten().to_numpy(), return_inverse=True)
        visited = np.zeros((len(queries), len(names) + 1), bool)
        for row, some in enumerate(cells.take(pa.array(queries)).to_pylist()):
            at = np.searchsorted(names, some)
            visited[row, np.where(np.isin(some, names), at, len(names))] = True
        asking = ids[queries]

        def allowed(low: int, high: int) -> np.ndarray:
            return visited[:, own[low:high]] & (asking[:, None] != ids[entries[low:high]][None, :])

        row, distance, found = _nearest(values[queries], values[entries], ids[entries], allowed, k)
        return pa.table({"query_id": asking[row], "vec_id": found, "score": distance})
    return tile


def _met(table: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id and score: the best of every tile."""
    group = ["dim", "part"]
    entries = table.groupBy(*group).agg(F.ceil(F.count("*") / ENTRIES).alias("slots"))
    asking = asked.groupBy(*group).agg(F.ceil(F.count("*") / ASKING).alias("asks_slots"))
    dealt = written(entries.join(asking, group), "dealt")  # a row a group, of which there are MOST * MOST a length

    def side(rows: DataFrame, cells: Column, own: str, other: str, asks: bool) -> DataFrame:
        slot = F.pmod(F.xxhash64("row"), F.col(own)).alias("own")
        met = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias("other")
        names = ("ask", "slot") if asks else ("slot", "ask")
        return rows.join(F.broadcast(dealt), group).select(
            *group, slot, met, "vec_id", "embedding", cells.alias("cells"), F.lit(asks).alias("asks")
        ).withColumnsRenamed({"own": names[0], "other": names[1]})

    tiles = side(table, F.array("cell"), "slots", "asks_slots", False).unionByName(
        side(asked, F.col("cells"), "asks_slots", "slots", True))
    return tiles.groupBy(*group, "slot", "ask").applyInArrow(
        _rerank(k), "query_id long, vec_id long, score double")


def search(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score (the Euclidean distance): of the rows of ``vectors``
    (vec_id, embedding) the ``k`` nearest found for each one that ``is_query`` marks."""
    some = F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = vectors.where(finite("embedding") & some & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("dim"), "embedding",
        F.coalesce(is_query, F.lit(False)).alias("asks"))
    size = rows.agg(F.count("*").alias("n"), F.max("dim").alias("dim")).first()
    plain, queries = rows.drop("asks"), rows.where("asks").drop("asks")
    index = fit(plain, size.n, size.dim or 0)
    table = indexed(plain, index)
    order = F.xxhash64("vec_id", "embedding")
    # The same number of queries whatever the lengths: they are read whole by the driver.
    probes = queries.orderBy(order, "vec_id").limit(max(1, min(PROBES, SAMPLE_VALUES // max(size.dim or 1, 1)))).collect()
    share = depth(index, table, probes, k)
    found = written(_met(table, _asked(queries, index, share, k), k), "found")
    complete = found.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n")).where(F.col("n") >= k)
    short = written(queries.join(complete, F.col("vec_id") == F.col("query_id"), "left_anti"), "short")
    if not short.isEmpty():
        found = found.unionByName(_met(table, _asked(short, index, 1.0, k), k))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    nearest = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return nearest.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
