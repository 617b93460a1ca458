"""Exact top-k search by inner product, in tiles of queries and candidates.

Queries and candidates are dealt by hash into slots of bounded size; each pair of slots is
one tile, whose scores come from a matrix product. A tile keeps the best few of every query,
and these lists are merged in a tree of bounded width.

Vectors that are null or hold null or non-finite components take no part, and vectors of
unlike lengths do not meet. Ties go to the smaller id. A row never answers its own id; of
repeated rows with one id the best score counts. Scores past 64 bits stop at its bounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmart.llm.vectors import finite, matrix

#: Rows of one slot.
CANDIDATES, QUERIES = 8192, 8192
#: Columns of a matrix product that are held at once.
COLUMNS = 2048
#: Lists that one step of the tree merges.
FAN = 64
SCALE = 256


def scaled(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors)


def products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles where these hold them, else in Python's integers."""
    most = np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * max(queries.shape[1], 1)
    if most < 2 ** 53:
        return (queries @ candidates.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (queries, candidates)]
    return np.clip(whole[0] @ whole[1].T, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def best(query: np.ndarray, score: np.ndarray, candidate: np.ndarray, k: int):
    """Of a list of (query, score, candidate) the ``k`` best of each query, best first."""
    order = np.lexsort((candidate, ~score, query))  # ~ turns the order and never overflows
    query, score, candidate = query[order], score[order], candidate[order]
    again = np.zeros(len(query), bool)
    again[1:] = (query[1:] == query[:-1]) & (candidate[1:] == candidate[:-1]) & (score[1:] == score[:-1])
    query, score, candidate = query[~again], score[~again], candidate[~again]
    new = np.ones(len(query), bool)
    new[1:] = query[1:] != query[:-1]
    first = np.flatnonzero(new)
    place = np.arange(len(query)) - first[np.cumsum(new) - 1]
    return query[place < k], score[place < k], candidate[place < k]


def _tile(queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, ids: np.ndarray, k: int):
    """Positions of queries, scores and ids of the best candidates."""
    kept = (np.empty(0, np.int64),) * 3
    for at in range(0, len(ids), COLUMNS):
        part = ids[at:at + COLUMNS]
        scores = products(queries, candidates[at:at + COLUMNS])
        allowed = query_ids[:, None] != part[None, :]
        shown = np.where(allowed, scores, np.iinfo(np.int64).min)
        last = max(len(part) - k, 0)
        bound = np.partition(shown, last, axis=1)[:, last]
        row, column = np.nonzero((shown >= bound[:, None]) & allowed)
        found = (row, scores[row, column], part[column])
        kept = best(*(np.concatenate([a, b]) for a, b in zip(kept, found)), k)
    return kept


_FOUND = "query_id long, vec_id long, score long, slot long"


def top(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` best rows of ``vectors`` (vec_id, embedding)
    for each of its rows that ``is_query`` marks."""
    rows = vectors.where(finite("embedding") & F.col("vec_id").isNotNull()).select(
        "vec_id", "embedding", F.size("embedding").alias("dim"), is_query.alias("asks"))
    size = rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("asks"), 1)).alias("q")).first()
    slots, asking = max(1, -(-size.n // CANDIDATES)), max(1, -(-size.q // QUERIES))
    row_hash = F.xxhash64("vec_id")

    def numbers(n: int) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))

    queries = rows.where("asks").select(
        "vec_id", "embedding", "dim", F.pmod(row_hash, F.lit(asking)).cast("long").alias("q"),
        F.explode(numbers(slots)).alias("slot"), F.lit(True).alias("asks"))
    candidates = rows.select(
        "vec_id", "embedding", "dim", F.explode(numbers(asking)).alias("q"),
        F.pmod(row_hash, F.lit(slots)).cast("long").alias("slot"), F.lit(False).alias("asks"))

    def tile(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids, values = table.column("vec_id").to_numpy(), scaled(matrix(table.column("embedding")))
        query, score, candidate = _tile(values[asks], ids[asks], values[~asks], ids[~asks], k)
        return pa.table({
            "query_id": pa.array(ids[asks][query], pa.int64()), "vec_id": pa.array(candidate, pa.int64()),
            "score": pa.array(score, pa.int64()),
            "slot": pa.array(np.full(len(query), table.column("slot")[0].as_py()))})

    found = queries.unionByName(candidates).groupBy("dim", "q", "slot").applyInArrow(tile, _FOUND)
    order = (F.desc("score"), F.col("vec_id"))
    while slots > FAN:
        slots = -(-slots // FAN)
        found = (
            found.withColumn("slot", F.floor(F.col("slot") / FAN))
            .withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "slot").orderBy(*order)))
            .where(F.col("rank") <= k).drop("rank"))
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
