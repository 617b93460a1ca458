"""Near-duplicate vectors by sorted projection passes.

Equal vectors are one class. In each pass every class gets a code, the signs of its
products with random directions, drawn anew for the pass; classes are ordered by their codes
as text and each is compared with at least the next ones of a window. Alike vectors share most
signs, so that in some pass they lie close by. How likely a pass misses a pair is taken from
the data: the first class beyond a class's window, or the last one its task has, tells how many
leading signs must agree for an alike one to lie inside. A class takes part in passes until the
product of these shares is at most ``MISSED``; in a dense group that takes far more passes than
elsewhere. Classes that ``LEAST_PASSES`` have not brought there are a dense group; once the
passes have cost as much as comparing all of it with itself, just that is done, so no class is
left with less. Pairs that are alike are united over all passes into components. A window holds
no more than a bounded part of a large component, so all classes of a component are then
compared with one another, in tiles of bounded size that only count links.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing
and are their own component; so do rows without a vec_id. Vectors of unlike lengths do not
meet. Equal rows are one vector. Rows with one vec_id and unlike vectors are vectors of their
own, each with its own links and component; another vector counts both.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmart.llm.common import written
from wardmart.llm.components import components
from wardmart.llm.vectors import finite, matrix

COSINE = 0.95
#: Classes that each one is compared with to either side: a share of all, within bounds.
WINDOW, LEAST_WINDOW, WINDOW_SHARE = 1024, 8, 1 / 32
#: Share of pairs at the threshold that all passes of a class together may miss, were the signs
#: of alike classes independent of those of the others. In a dense group they are not quite, and
#: more are missed: hence so little.
MISSED = 0.0001
#: Passes of the first round, each later one doubles their number; passes before all classes
#: that are left count as one dense group.
PASSES, LEAST_PASSES = 8, 64
BITS = 60
#: Classes of one side of a tile that counts links, and of one that compares all that is left.
TILE = 1024
SIDE = 4096


def _directions(which: int, dim: int) -> np.ndarray:
    return np.random.default_rng([17, which, dim]).normal(size=(dim, BITS))


def window_for(n: int) -> int:
    return min(WINDOW, max(LEAST_WINDOW, math.ceil(n * WINDOW_SHARE)))


def _coder(passes: range):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                part = batch.take(pa.array(at))
                values = matrix(part.column("embedding"))
                for p in passes:
                    code = ((values @ _directions(p, int(dim))) > 0) @ weights
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), p, np.int32)), part.column("dim"), pa.array(code),
                         part.column("node"), part.column("embedding")],
                        names=["pass", "dim", "code", "node", "embedding"])
    return run


def _units(values: np.ndarray) -> np.ndarray:
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _joined(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewer links that connect the same ones of ``n`` rows: each with the first of its component."""
    first = np.arange(n)
    while len(a):
        low = np.minimum(first[a], first[b])
        new = first.copy()
        for side in (a, b):
            np.minimum.at(new, first[side], low)
            np.minimum.at(new, side, low)
        new = new[new]
        if np.array_equal(new, first):
            break
        first = new
    rows = np.flatnonzero(first != np.arange(n))
    return rows, first[rows]


def _gains(turn: np.ndarray, dim: np.ndarray, code: np.ndarray, window: int) -> np.ndarray:
    """Log of the share of pairs at the threshold that this pass may miss, for each sorted row.

    The further apart two rows stand, the fewer leading signs they share. So whoever shares more
    of them with a row than the first one out of its window does has been compared with it; at
    the end of a partition the last row stands for all beyond.
    """
    depth = np.zeros(len(code), np.int64)
    for side in (-window - 1, window + 1):
        at = np.clip(np.arange(len(code)) + side, 0, len(code) - 1)
        differ = code ^ code[at]
        high = differ >> 30
        length = np.where(high > 0, 30 + np.frexp(high)[1], np.frexp(differ & ((1 << 30) - 1))[1])
        same = (turn == turn[at]) & (dim == dim[at])
        depth = np.maximum(depth, np.where(same, BITS - length + 1, 0))
    together = (1 - math.acos(COSINE) / math.pi) ** depth
    return np.where(depth > BITS, 0.0, np.log(np.maximum(1 - together, 1e-300)))


def _neighbours(window: int):
    """Links between rows, sorted by code, and the next ones in their window; gains of all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        orders = []
        for batch in batches:
            orders.append([batch.column(c).to_numpy() for c in ("pass", "dim", "code", "node")])
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            held = table.slice(max(0, table.num_rows - window))
            turn, dim, node = (table.column(c).to_numpy() for c in ("pass", "dim", "node"))
            left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            cuts = np.flatnonzero((turn[1:] != turn[:-1]) | (dim[1:] != dim[:-1])) + 1
            for low, high in zip([0, *cuts], [*cuts, len(turn)]):
                unit = _units(matrix(table.column("embedding").slice(low, high - low)))
                for at in range(0, high - low, window):
                    block = unit[at:at + 2 * window]
                    a, b = np.nonzero(np.triu(block[:window] @ block.T >= COSINE, 1))
                    a, b = _joined(a, b, len(block))
                    left.append(node[low + at + a])
                    right.append(node[low + at + b])
            a, b = np.concatenate(left), np.concatenate(right)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b), pa.nulls(len(a), pa.float64())], names=["a", "b", "gain"])
        if orders:
            turn, dim, code, node = (np.concatenate(x) for x in zip(*orders))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(node), pa.array(_gains(turn, dim, code, window))], names=["a", "b", "gain"])
    return run


def all_links(nodes: DataFrame, n: int) -> DataFrame:
    """Links (a, b) that connect all alike ones of ``n`` nodes: every one is compared with every one."""
    tiles = max(1, -(-n // SIDE))
    dealt = (nodes.withColumn("own", F.pmod(F.xxhash64("node"), F.lit(tiles)))
             .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long")))))
    pair = (F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"))

    def tile(table: pa.Table) -> pa.Table:
        own, i, j = (table.column(c).to_numpy() for c in ("own", "i", "j"))
        node = table.column("node").to_numpy()
        unit = _units(matrix(table.column("embedding")))
        first = np.flatnonzero(own == i)
        other = first if i[0] == j[0] else np.flatnonzero(own != i)
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        across = unit[other].T
        for at in range(0, len(first), TILE):
            a, b = np.nonzero(unit[first[at:at + TILE]] @ across >= COSINE)
            a, b = _joined(first[at + a], other[b], len(node))
            left.append(node[a])
            right.append(node[b])
        return pa.table({"a": pa.array(np.concatenate(left)), "b": pa.array(np.concatenate(right))})

    return (dealt.select("dim", "node", "embedding", "own", *pair)
            .groupBy("dim", "i", "j").applyInArrow(tile, "a long, b long"))


def window_links(nodes: DataFrame, n: int) -> DataFrame:
    """Links (a, b) that connect all alike nodes found in the windows of all passes."""
    keys = ("pass", "dim", "code", "node")
    kind = nodes.schema["embedding"].dataType.simpleString()
    left = nodes.select("node", "dim", "embedding", F.lit(0.0).alias("missed"))
    links, done, step = [], 0, PASSES
    while n > 1 and (done < LEAST_PASSES or (done + step) * 2 * WINDOW < n):
        window = window_for(n)
        coded = left.mapInArrow(
            _coder(range(done, done + step)), f"pass int, dim int, code long, node long, embedding {kind}")
        found = written(
            coded.repartitionByRange(max(1, n * step // (32 * window)), *keys).sortWithinPartitions(*keys)
            .mapInArrow(_neighbours(window), "a long, b long, gain double"), "pass")
        links.append(found.where("gain is null").select("a", "b").distinct())
        gains = found.where("gain is not null").groupBy(F.col("a").alias("node")).agg(F.sum("gain").alias("gain"))
        left = written(
            left.join(gains, "node").withColumn("missed", F.col("missed") + F.col("gain")).drop("gain")
            .where(F.col("missed") > math.log(MISSED)), "left")
        n = left.count()
        done, step = done + step, done + step
    out = all_links(left, n) if n > 1 else nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    for some in links:
        out = out.union(some)
    return out.distinct()


def counted_links(members: DataFrame) -> DataFrame:
    """node and links: how many rows the nodes alike to each one stand for, within its component.

    ``members`` has component, node, size (rows the node stands for), dim and embedding.
    """
    sizes = members.groupBy("component", "dim").agg(F.count("*").alias("n"))
    tiles = F.ceil(F.col("n") / TILE)
    dealt = (
        members.join(sizes.where("n > 1"), ["component", "dim"])
        .withColumn("own", F.pmod(F.xxhash64("node"), tiles))
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1))))
    pair = (F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"))

    def tile(table: pa.Table) -> pa.Table:
        own, i, j = (table.column(c).to_numpy() for c in ("own", "i", "j"))
        node, size = table.column("node").to_numpy(), table.column("size").to_numpy()
        unit = _units(matrix(table.column("embedding")))
        first = own == i
        a, b = np.flatnonzero(first), np.flatnonzero(~first)
        b = a if i[0] == j[0] else b
        alike = unit[a] @ unit[b].T >= COSINE
        alike &= node[a][:, None] != node[b][None, :]
        counts = np.zeros(len(node))
        counts[a] = alike @ size[b]
        if i[0] != j[0]:
            counts[b] = alike.T @ size[a]
        return pa.table({"node": pa.array(node), "links": pa.array(counts.astype(np.int64))})

    return (dealt.select("component", "dim", "node", "size", "embedding", "own", *pair)
            .groupBy("component", "dim", "i", "j").applyInArrow(tile, "node long, links long")
            .groupBy("node").agg(F.sum("links").alias("links")))


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding).

    A node is a class of equal vectors and stands for as many vectors as it has vec_ids.
    """
    both = [F.xxhash64("embedding").alias("h"), F.xxhash64(F.lit(7), "embedding").alias("h2")]
    some = F.exists("embedding", lambda x: x != 0)
    usable = finite("embedding") & F.coalesce(some, F.lit(False)) & F.col("vec_id").isNotNull()
    marked = vectors.select("vec_id", "embedding", usable.alias("usable"))
    valid = marked.where("usable").select("vec_id", "embedding", F.size("embedding").alias("dim"), *both)
    classes = written(
        valid.groupBy("h", "h2", "vec_id").agg(F.first("dim").alias("dim"), F.first("embedding").alias("embedding"))
        .groupBy("h", "h2").agg(
            F.min("vec_id").alias("least"), F.count("*").alias("size"), F.first("dim").alias("dim"),
            F.first("embedding").alias("embedding"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    nodes = classes.select("node", "size", "dim", "embedding")
    found = written(components(written(window_links(nodes, nodes.count()), "links")), "components")
    links = counted_links(nodes.join(found, "node"))
    known = (
        classes.select("h", "h2", "node", "least", "size").join(found, "node", "left").join(links, "node", "left")
        .select("h", "h2", "least", "component", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links")))
    smallest = known.where("component is not null").groupBy("component").agg(F.min("least").alias("smallest"))
    known = written(
        known.join(smallest, "component", "left")
        .select("h", "h2", F.coalesce("smallest", "least").alias("component"), "links"), "known")
    keyed = marked.select("vec_id", *(F.when(F.col("usable"), c).alias(k) for c, k in zip(both, ("h", "h2"))))
    out = keyed.join(known, ["h", "h2"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
