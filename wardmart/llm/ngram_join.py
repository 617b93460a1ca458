"""Join of documents whose sets of word shingles are alike, by PartEnum signatures.

Sets are dealt into bands of similar size. Two sets with a Jaccard similarity of
``PERCENT`` / 100 or more lie in the same band or in neighbours, and differ in at most k
shingles, where k follows from the upper size of the band. For each of its two bands a set's
shingles are dealt by hash into first-level partitions of two second-level parts each; one
signature is made for every subset of one part, from all shingles of the set in it. There
are more than k parts, so two sets that alike agree on some of them. Small sets (k up to 2)
take every shingle as a part of its own and enumerate the subsets that leave out up to k.

Signatures of parts without shingles would join everything, so they are left out; a set with
so many of them that an agreement might be lost is *thin* and gets further signatures, which
only meet those of other thin sets. Shingles that are very frequent in a bounded sample are
left out of the first signatures (two sets differ no more without them); sets that mostly
consist of such shingles are thin. Neither changes which pairs are found.

Sets that share a signature are first compared with the member of the group that shares most
with others, their lead, which joins groups of near copies into one component each. Then, if
the sets with one lead still belong to several components, sets of different ones are compared
in tiles of bounded size.
Both comparisons begin with parity sketches (a bit for each hash value, turned over by each
shingle: two sketches differ in no more bits than the sets in shingles), which rule out nearly
all sets that only share a passage; what is left is verified on the whole sets. For each two
components the closest pairs are tried, and more of them in a next round if these fail, so no
group is ever written out as all its pairs and no link between components is lost.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardmart.llm.common import (
    Prefixes, among, forget, freeing, mixed, partitions, release, slices, utf8, word_spans,
    written,
)
from wardmart.llm.components import components

WORDS = 5
PERCENT = 80
#: Documents in the sample that frequent shingles are taken from, and in how many of them
#: (in thousandths) a shingle must be to count as frequent.
SAMPLE = 4000
FREQUENT = 5
#: Sets on one side of a tile.
TILE = 1024
#: Pairs of two components that the first round verifies; each later one sixteen times as many.
TRIED = 4
#: Bits of a parity sketch for each shingle: half of these to all. More rule out more pairs.
SKETCH_BITS = 8

_STEP = np.uint64(0x9DDFEA08EB382D69)
_LEVELS, _OUT = 2, 1  # second-level parts, and how many of them a subset leaves out


# Sets

def shingle_sets(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's different shingles, sorted by row and hash, and each one's row."""
    lower = data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)
    begin, end, row = word_spans(lower, starts)
    if not len(begin):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    word = Prefixes(lower).spans(begin, end)
    hashed = word.copy()
    for t in range(1, WORDS):
        hashed[:-t] = hashed[:-t] * _STEP + word[t:]
    n = np.bincount(row, minlength=len(starts) - 1)
    first = np.cumsum(n) - n
    place = np.arange(len(row)) - first[row]
    whole = place + WORDS <= n[row]
    # A text of fewer words is one sequence; its words are hashed one after the other.
    short = np.flatnonzero((n > 0) & (n < WORDS))
    sequence = np.zeros(len(short), np.uint64) + n[short].astype(np.uint64)
    for t in range(WORDS - 1):
        more = n[short] > t
        at = first[short][more] + t
        sequence[more] = mixed(sequence[more] * _STEP + word[at])
    hashes = np.concatenate([mixed(hashed[whole]), sequence])
    rows = np.concatenate([row[whole], short])
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[new], rows[new]


def _each(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a batch: first and last row, shingles, and their rows from the first on."""
    release()
    data, starts = utf8(column)
    for i, j in slices(starts):
        hashes, rows = shingle_sets(data[starts[i]:starts[j]], starts[i:j + 1] - starts[i])
        yield i, j, hashes, rows


def _sums(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    np.add.at(out, at, values)
    return out


def set_keys(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit keys of each row's whole set."""
    return (mixed(_sums(mixed(hashes + np.uint64(1)), rows, n)),
            mixed(_sums(mixed(hashes ^ np.uint64(0x5BD1E9955BD1E995)), rows, n)))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, and key and key2 of the set, which equal sets share."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, hashes, rows in _each(batch.column("text")):
                keys = [pa.array(k.view(np.int64)) for k in set_keys(hashes, rows, j - i)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i),
                     pa.array(np.bincount(rows, minlength=j - i)), *keys],
                    names=["doc_id", "n_shingles", "key", "key2"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_shingles long, key long, key2 long")


def sets(docs: DataFrame) -> DataFrame:
    """doc_id and ``shingles``, the hashes of its set."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, hashes, rows in _each(batch.column("text")):
                ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=j - i))])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), lists], names=["doc_id", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, shingles array<long>")


# Signatures

@cache
def bands() -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper size of each band."""
    low, high = [1], [100 // PERCENT]
    while high[-1] < 1 << 40:
        low.append(high[-1] + 1)
        high.append(low[-1] * 100 // PERCENT)
    return np.array(low), np.array(high)


@cache
def most_different(band: int) -> int:
    """k: how many shingles two alike sets of at most the band's upper size can differ in."""
    return int(2 * bands()[1][band]) * (100 - PERCENT) // (100 + PERCENT)


@cache
def parts_of(band: int) -> int:
    """Parts: more than k, by enough that few sets are thin, also the smallest that come here."""
    k, least = most_different(band), int(bands()[0][max(band - 1, 0)])

    def spare(parts: int) -> float:
        empty = parts * np.exp(-least / parts)
        return parts - k - empty - 3 * np.sqrt(empty)

    tries = range(k + 2, 2 * k + 12)
    found = next((p for p in tries if spare(p) > 1), max(tries, key=spare))
    return -(-found // _LEVELS) * _LEVELS


def _small(hashes: np.ndarray, band: int, k: int) -> np.ndarray:
    """Signatures of all subsets that leave out up to ``k`` shingles."""
    values, wrap = hashes.tolist(), (1 << 64) - 1
    total = sum(values)
    left = [total & wrap]
    for n in range(1, k + 1):
        if len(values) > n:
            left += [(total - sum(out)) & wrap for out in itertools.combinations(values, n)]
    return mixed(np.array(left, np.uint64) + mixed(np.array([band * 4 + 3], np.uint64)))


def _subsets(cells: np.ndarray, filled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For partitions by parts: the sum and whether there is anything, for each subset of parts."""
    kept = [list(c) for c in itertools.combinations(range(_LEVELS), _LEVELS - _OUT)]
    return (np.stack([cells[:, c].sum(axis=1, dtype=np.uint64) * np.uint64(2 * i + 1)
                      for i, c in enumerate(kept)], axis=1),
            np.stack([filled[:, c].any(axis=1) for c in kept], axis=1))


def _signatures(hashes, rows, keep, size, band, space, thin_only, n):
    """Signatures of rows in one band each: row and signature, and which rows are thin.

    ``keep`` marks the shingles that count; ``space`` separates two kinds of signatures.
    With ``thin_only`` rows that stay thin get the signatures of empty parts as well.
    """
    parts = np.array([parts_of(b) for b in range(int(band.max()) + 1)])[band]
    k = np.array([most_different(b) for b in range(int(band.max()) + 1)])[band]
    first = np.cumsum(parts) - parts
    total = int(parts.sum())
    h, r = hashes[keep], rows[keep]
    # Another dealing for each band; the high half of the product picks the part.
    deal = mixed(h ^ mixed(band.astype(np.uint64) + np.uint64(101))[r]) >> np.uint64(32)
    part = ((deal * parts[r].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    cell = first[r] + part
    cells = _sums(mixed(h + np.uint64(77)), cell, total)
    filled = np.zeros(total, bool)
    filled[cell] = True
    owner = np.repeat(np.arange(n), parts)
    empty = np.bincount(owner[~filled], minlength=n)
    thin = empty >= parts - k
    sums, any_in = _subsets(cells.reshape(-1, _LEVELS), filled.reshape(-1, _LEVELS))
    group = np.arange(len(sums)) - (first // _LEVELS)[owner[::_LEVELS]]
    where = (band[owner[::_LEVELS]].astype(np.uint64) * np.uint64(1 << 40)
             + group.astype(np.uint64) * np.uint64(4) + np.uint64(space))
    numbers = np.arange(sums.shape[1], dtype=np.uint64)
    found = mixed(sums + mixed(mixed(where)[:, None] + numbers))
    emit = any_in | (thin[owner[::_LEVELS]][:, None] if thin_only else False)
    at, _ = np.nonzero(emit)
    return owner[::_LEVELS][at], found[emit], thin


def signatures_of(hashes: np.ndarray, rows: np.ndarray, n: int, frequent: np.ndarray):
    """Row and signature of all signatures of ``n`` sets."""
    size = np.bincount(rows, minlength=n)
    own = np.searchsorted(bands()[1], np.maximum(size, 1))
    out_row, out = [], []
    rare = np.ones(len(hashes), bool)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        rare = frequent[at] != hashes
    ends = np.cumsum(size)
    ks = np.array([most_different(b) for b in range(int(own.max()) + 2)]) if n else np.empty(0)
    for band in (own, own + 1):
        for i in np.flatnonzero((ks[band] <= 2) & (size > 0)):
            found = _small(hashes[ends[i] - size[i]:ends[i]], int(band[i]), int(ks[band[i]]))
            out.append(found)
            out_row.append(np.full(len(found), i))
        big = np.flatnonzero((ks[band] > 2) & (size > 0))
        keep = np.ones(len(hashes), bool)
        for space, only in ((1, rare), (2, keep)):
            if not len(big):
                break
            renumber = np.full(n, -1)
            renumber[big] = np.arange(len(big))
            mine = renumber[rows] >= 0
            h, r = hashes[mine], renumber[rows[mine]]
            row, found, thin = _signatures(
                h, r, only[mine], size[big], band[big], space, space == 2, len(big))
            out_row.append(big[row])
            out.append(found)
            big = big[thin]
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(out_row), np.concatenate(out)


def _signer(frequent: np.ndarray):
    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, hashes, rows in _each(batch.column("text")):
                key, _ = set_keys(hashes, rows, j - i)
                row, found = signatures_of(hashes, rows, j - i, frequent)
                order = np.argsort(row, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=j - i))])
                lists = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(found[order].view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), lists], names=["key", "signatures"])
    return run


def frequent_shingles(docs: DataFrame, n: int) -> np.ndarray:
    """Sorted hashes of the shingles that are frequent in a sample of about ``SAMPLE`` documents.

    A sample has a bounded number of shingles that at least ``FREQUENT`` in a thousand of
    its documents share: at most 1000 / ``FREQUENT`` times the shingles of one document.
    """
    part = docs.sample(min(1.0, SAMPLE / max(n, 1)), seed=3)
    least = max(10, min(n, SAMPLE) * FREQUENT // 1000)
    rows = (sets(part).select(F.explode("shingles").alias("h")).groupBy("h").count()
            .where(F.col("count") >= least).select("h").toPandas())
    return np.sort(rows.h.to_numpy(np.int64).view(np.uint64))


# Groups of sets that share a signature

@freeing
def _shared_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by signature and key: one row for each key of signatures with several keys."""
    names = ["signature", "key"]
    # The last row of the batch before, and whether it was already given out.
    held: tuple[int, int, bool] | None = None
    for batch in batches:
        s, k = (batch.column(c).to_numpy() for c in names)
        if not len(s):
            continue
        given = False
        if held is not None:
            s, k = np.append(held[0], s), np.append(held[1], k)
            given = held[2]
        same = s[1:] == s[:-1]
        step = np.ones(len(s), bool)  # a key's first row within its signature
        step[1:] = ~same | (k[1:] != k[:-1])
        s, k = s[step], k[step]
        joined = s[1:] == s[:-1]
        out = np.zeros(len(s), bool)
        out[1:] |= joined
        out[:-1] |= joined
        last = bool(out[-1]) or (given and len(s) == 1)
        held = (s[-1], k[-1], last)
        if given:
            out[0] = False
        yield pa.RecordBatch.from_arrays([pa.array(s[out]), pa.array(k[out])], names=names)


@contextmanager
def batches_of(spark, rows: int):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def groups(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """lead, key: keys of sets that share signatures, by the one that shares most with others.

    Two sets that share a signature have some lead in common; a lead is among its own.
    """
    spark = docs.sparkSession
    signed = docs.select("text").mapInArrow(_signer(frequent), "key long, signatures array<long>")
    rows = signed.select(F.explode("signatures").alias("signature"), "key")
    shared = (rows.repartition(partitions(spark), "signature").sortWithinPartitions("signature", "key"))
    with batches_of(spark, 20_000):
        members = written(shared.mapInArrow(_shared_runs, "signature long, key long"), "members")
    hashed = F.xxhash64("key").cast("decimal(38,0)")
    one = (
        members.groupBy("signature").agg(F.count("*").alias("n"), F.sum(hashed).alias("s"), F.min("key").alias("low"))
        .groupBy("n", "s", "low").agg(F.min("signature").alias("signature")))
    kept = written(members.join(one.select("signature", "n"), "signature"), "groups")
    degree = kept.groupBy("key").agg(F.sum("n").alias("degree"))
    place = F.row_number().over(Window.partitionBy("signature").orderBy(F.desc("degree"), "key"))
    placed = written(kept.join(degree, "key").select("signature", "key", place.alias("place")), "places")
    first = placed.where("place = 1").select("signature", F.col("key").alias("lead"))
    return placed.join(first, "signature").select("lead", "key").distinct()


# Links

def _bits(n: int) -> int:
    return max(256, 1 << (SKETCH_BITS * n).bit_length() - 1)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n and ``sketch``: the parity of the number of shingles at each of its bits."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, hashes, rows in _each(batch.column("text")):
                size = np.bincount(rows, minlength=j - i)
                bits = np.array([_bits(n) for n in size.tolist()], np.int64)
                ends = np.cumsum(bits)
                at = (mixed(hashes + np.uint64(9)) & (bits[rows] - 1).astype(np.uint64)).astype(np.int64)
                odd = np.bincount((ends - bits)[rows] + at, minlength=int(ends[-1])) & 1
                packed = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
                parts = [packed[(e - b) // 8:e // 8] for e, b in zip(ends.tolist(), bits.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(size), pa.array(parts, pa.binary())],
                    names=["doc_id", "n", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, sketch binary")


def _folded(sketch: bytes, size: int) -> bytes:
    while len(sketch) > size:
        half = len(sketch) // 2
        both = int.from_bytes(sketch[:half], "little") ^ int.from_bytes(sketch[half:], "little")
        sketch = both.to_bytes(half, "little")
    return sketch


@freeing
def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches and sizes allow that they are alike."""
    for batch in batches:
        keep = []
        for x, y, n, m in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "nx", "ny"))):
            size = min(len(x), len(y))
            x, y = (int.from_bytes(_folded(s, size), "little") for s in (x, y))
            keep.append((x ^ y).bit_count() * (100 + PERCENT) <= (n + m) * (100 - PERCENT))
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], names=["a", "b"])


def _sizes_fit(n, m):
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def star_pairs(members: DataFrame, drawn: DataFrame) -> DataFrame:
    """Each lead with each other set of its own, if their sketches allow it."""
    kind = members.schema["doc_id"].dataType.simpleString()
    pairs = members.where("lead <> doc_id").select(
        F.least("lead", "doc_id").alias("a"), F.greatest("lead", "doc_id").alias("b")).distinct()
    left = drawn.toDF("a", "nx", "x")
    right = drawn.toDF("b", "ny", "y")
    return (pairs.join(left, "a").join(right, "b").where(_sizes_fit(F.col("nx"), F.col("ny")))
            .mapInArrow(_possible, f"a {kind}, b {kind}").distinct())


def _closest(pairs: np.ndarray, component: np.ndarray, tried: int) -> np.ndarray:
    """Of pairs (two places, distance, whether others were left out) each two components' closest."""
    p, q, unlike, _ = pairs
    low, high = np.minimum(component[p], component[q]), np.maximum(component[p], component[q])
    order = np.lexsort((q, p, unlike, high, low))
    pairs, low, high = pairs[:, order], low[order], high[order]
    if not len(low):
        return pairs
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    first, group = np.flatnonzero(new), np.cumsum(new) - 1
    keep = np.arange(len(low)) - first[group] < tried
    more = np.bincount(group, ~keep | (pairs[3] > 0)) > 0
    pairs[3] = more[group]
    return pairs[:, keep]


def _tile_pairs(tried: int):
    def run(table: pa.Table) -> pa.Table:
        forget()
        own, i, j = (table.column(c).to_numpy() for c in ("own", "i", "j"))
        n = table.column("n").to_numpy()
        _, component = np.unique(table.column("component").to_numpy(), return_inverse=True)
        drawn = table.column("sketch").to_pylist()
        size = min(map(len, drawn))
        bits = np.frombuffer(b"".join(_folded(s, size) for s in drawn), np.uint64).reshape(len(drawn), -1)
        a = np.flatnonzero(own == i)
        b = a if i[0] == j[0] else np.flatnonzero(own == j)
        kept = np.empty((4, 0), np.int64)
        step = max(1, (1 << 19) // max(1, len(b) * bits.shape[1]))
        for at in range(0, len(a), step):
            x = a[at:at + step]
            unlike = np.bitwise_count(bits[x][:, None] ^ bits[b][None]).sum(axis=2, dtype=np.int32)
            both = n[x][:, None] + n[b][None]
            fit = 100 * np.minimum(n[x][:, None], n[b][None]) >= PERCENT * np.maximum(n[x][:, None], n[b][None])
            fit &= unlike * (100 + PERCENT) <= both * (100 - PERCENT)
            fit &= component[x][:, None] != component[b][None]
            p, q = np.nonzero(fit)
            found = np.stack([x[p], b[q], unlike[p, q], np.zeros(len(p), np.int64)])
            kept = _closest(np.concatenate([kept, found], axis=1), component, tried)
        p, q, _, more = kept
        ids = table.column("doc_id")
        return pa.table({"a": ids.take(pa.array(p)), "b": ids.take(pa.array(q)), "more": pa.array(more > 0)})
    return run


def open_pairs(members: DataFrame, known: DataFrame, drawn: DataFrame, tried: int) -> DataFrame:
    """Pairs a, b of sets with one lead but of different components that may be alike.

    For each two components of a tile the ``tried`` closest; ``more`` says if there are others.
    """
    kind = members.schema["doc_id"].dataType.simpleString()
    now = (members.join(known.withColumnRenamed("node", "doc_id"), "doc_id", "left")
           .withColumn("component", F.coalesce("component", "doc_id")))
    still = now.groupBy("lead").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size")).where("x <> y")
    tiles = F.ceil(F.col("size") / TILE)
    dealt = (
        now.join(still.select("lead", "size"), "lead").join(drawn, "doc_id")
        .withColumn("own", F.pmod(F.xxhash64("doc_id"), tiles))
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1))))
    return (dealt.select("lead", "doc_id", "n", "component", "sketch", "own",
                         F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"))
            .groupBy("lead", "i", "j").applyInArrow(_tile_pairs(tried), f"a {kind}, b {kind}, more boolean")
            .groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("more").alias("more")))


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b of doc_id) whose whole sets are alike enough."""
    ends = pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select("b"))
    found = written(sets(among(docs, ends, "doc_id")), "sets")
    left = found.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = found.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - both
    return (pairs.select("a", "b").join(left, "a").join(right, "b")
            .where(100 * both.cast("long") >= PERCENT * union.cast("long")).select("a", "b"))


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    Texts without words (or null) have 0 shingles and are alone; so is a null doc_id.
    Repeated doc_ids are one document; other columns play no part.
    """
    docs = docs.select("doc_id", "text")
    found = written(classes(docs), "classes")
    n = found.count()
    named = found.where("n_shingles > 0 and doc_id is not null")
    one = written(named.groupBy("key", "key2", "n_shingles").agg(F.min("doc_id").alias("rep")), "reps")
    members = groups(docs, frequent_shingles(docs, n))
    rep = one.select("key", F.col("rep").alias("doc_id"))
    lead = one.select(F.col("key").alias("lead"), F.col("rep").alias("lead_id"))
    members = written(
        members.join(rep, "key").join(lead, "lead").select(F.col("lead_id").alias("lead"), "doc_id").distinct(),
        "members")
    drawn = written(sketches(among(docs, members, "doc_id")), "sketches")
    links = written(verified(docs, written(star_pairs(members, drawn), "pairs")), "links")
    known = written(components(links), "components")
    tried = TRIED
    while True:
        pairs = written(open_pairs(members, known, drawn, tried), "pairs")
        if pairs.isEmpty():
            break
        new = written(verified(docs, pairs), "links")
        links = links.unionAll(new)
        known = written(components(links), "components")
        if pairs.where("more").isEmpty():
            break
        tried *= 16
    rep = one.select("key", "key2", "rep")
    out = found.join(rep, ["key", "key2"], "left")
    out = out.join(known.withColumnRenamed("node", "rep"), "rep", "left")
    alone = F.col("n_shingles") == 0
    return out.select(
        "doc_id", "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.coalesce("component", "rep", "doc_id")).alias("component_id"))
