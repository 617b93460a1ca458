"""Repeated stretches of text, removed after their first place, by a sparse suffix array.

A stretch of ``LENGTH`` bytes (a window) is removed if the same bytes start earlier: in a
document of smaller doc_id, or before in the same one. Of all suffixes only anchors are kept:
in each window the place whose next ``KEY`` bytes have the least hash. Equal windows choose
equal anchors, so it is enough to compare what lies around them.

1. Anchors are range-partitioned by their leading bytes into buckets, at splitters from a
   sample chosen by hash. The order goes on with a hash of the context (all bytes of the windows
   that chose the anchor) and the place, so that a very frequent suffix spreads over several
   buckets. The number of buckets follows the counted bytes, and a task takes neighbouring
   buckets one after the other: what it holds does not grow with the data.
2. Each bucket sorts its suffixes by multikey quicksort, eight bytes at a time, deeper only
   where keys tie. Of neighbours with the same context all but the first are covered whole.
3. Where suffixes with the same leading bytes have different contexts, or touch a bucket's
   bounds, the first of each context is compared window by window with the others.

Null and empty texts stay as they are, as do texts without a doc_id, which is a whole number.
Rows that share a doc_id count as one document: equal places in them are one place, and they
are cut alike. Very long texts are read in overlapping blocks. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmart.llm.common import Prefixes, among, freeing, mixed, partitions, slices, utf8, written

LENGTH = 100
KEY = 24
#: Documents that the splitters are taken from at least, and anchors of these; anchors a bucket.
SAMPLE_DOCS, SAMPLE_ANCHORS, SAMPLE_A_BUCKET = 1000, 100_000, 8
#: Tasks for each shuffle partition of the session, and bytes of text whose anchors are a bucket.
TASKS, BUCKET_BYTES = 3, 8 << 20
#: Bytes of text from which one anchor is taken on average.
ANCHOR_BYTES = 38
#: Window starts that numpy looks at in one go.
BLOCK = 1 << 18
#: Contexts with the same leading bytes that are compared at once; more are dealt by window.
TOGETHER = 30_000

_REACH = LENGTH - KEY + 1  # places a window chooses from
_PLACE = np.uint64((1 << 28) - 1)


# Anchors

def _leading(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, zeros after the end."""
    n = len(data)
    padded = np.zeros(n + 16, np.uint8)
    padded[:n] = data
    out = np.empty(n, np.uint64)
    for shift in range(8):
        some = len(out[shift::8])
        out[shift::8] = padded[shift:shift + 8 * some].view(">u8")
    return out


def _least(keys: np.ndarray) -> np.ndarray:
    """The least of each ``_REACH`` neighbours, from block-wise running minima."""
    n = len(keys) - _REACH + 1
    blocks = -(-len(keys) // _REACH)
    table = np.full(blocks * _REACH, np.iinfo(np.uint64).max, np.uint64)
    table[:len(keys)] = keys
    table = table.reshape(blocks, _REACH)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[_REACH - 1:_REACH - 1 + n])


def _anchors(data: np.ndarray, starts: np.ndarray):
    """Leading words (three), context hash, row, first window and packed extents of all anchors."""
    n = len(data)
    if n < LENGTH:
        return None
    words = _leading(data)
    w1, w2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    w1[:-8], w2[:-16] = words[8:], words[16:]
    rank = mixed(mixed(words) + w1 * np.uint64(0x9E3779B97F4A7C15) + mixed(w2) * np.uint64(0xC2B2AE3D27D4EB4F))
    keys = (rank & ~_PLACE) | np.arange(n, dtype=np.uint64)
    chosen = (_least(keys)[:n - LENGTH + 1] & _PLACE).astype(np.int64)
    row = np.searchsorted(starts, np.arange(n - LENGTH + 1), "right") - 1
    inside = np.flatnonzero(np.arange(LENGTH, n + 1) <= starts[row + 1])
    if not len(inside):
        return None
    anchor = chosen[inside]
    first = np.ones(len(anchor), bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (row[inside][1:] != row[inside][:-1])
    at = np.flatnonzero(first)
    low = inside[at]
    high = inside[np.append(at[1:], len(inside)) - 1]
    anchor = anchor[at]
    context = Prefixes(data).spans(low, high + LENGTH) + (anchor - low).astype(np.uint64)
    return words[anchor], w1[anchor], w2[anchor], context, row[low], low, high - low


def anchors(data: np.ndarray, starts: np.ndarray):
    """As ``_anchors``, over slices and blocks; the places are offsets in each row's text."""
    for i, j in slices(starts, BLOCK):
        size = int(starts[j] - starts[i])
        for block in range(0, max(size, 1), BLOCK):
            # A text longer than a block is seen in blocks that overlap by one window.
            low, high = int(starts[i]) + block, min(int(starts[i]) + block + BLOCK + LENGTH - 1, int(starts[j]))
            found = _anchors(data[low:high], np.clip(starts[i:j + 1] - low, 0, high - low))
            if found is not None:
                *words, row, place, extent = found
                yield *words, row + i, place + low - starts[row + i], extent


_COLUMNS = ("w0", "w1", "w2", "context", "doc", "place")
_ROW = "bucket int, " + ", ".join(f"{c} long" for c in _COLUMNS)


def _composite(columns: list[np.ndarray]) -> np.ndarray:
    """The first five columns as byte strings that sort alike."""
    unsigned = [c.view(np.uint64) ^ np.uint64(1 << 63 if i == 4 else 0) for i, c in enumerate(columns[:5])]
    return np.ascontiguousarray(np.stack(unsigned, axis=1).astype(">u8")).view("S40").ravel()


def _anchor_rows(splitters: np.ndarray):
    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("doc_id").to_numpy().astype(np.int64)
            for w0, w1, w2, context, row, low, extent in anchors(*utf8(batch.column("text"))):
                columns = [w0, w1, w2, context, docs[row], (low << 8) | extent]
                bucket = np.searchsorted(splitters, _composite(columns), "right") if len(splitters) else np.zeros(len(w0), int)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket.astype(np.int32)), *(pa.array(c.view(np.int64)) for c in columns)],
                    names=["bucket", *_COLUMNS])
    return run


def splitters(docs: DataFrame, buckets: int, rows: int, size: int) -> np.ndarray:
    """Bounds of ``buckets`` equal ranges of suffixes, for ``rows`` texts of ``size`` bytes.

    Some documents are sampled, and of their anchors those with the least hashes. The sample
    is a few dozen bytes for each ``BUCKET_BYTES`` of text.
    """
    wanted = max(SAMPLE_ANCHORS, SAMPLE_A_BUCKET * buckets)
    share = min(1.0, max(SAMPLE_DOCS / max(rows, 1), SAMPLE_A_BUCKET * buckets * ANCHOR_BYTES / max(size, 1)))
    found = docs.sample(share, seed=9).mapInArrow(_anchor_rows(np.empty(0, "S40")), _ROW)
    found = found.select(*_COLUMNS).orderBy(F.xxhash64(*_COLUMNS)).limit(wanted).toPandas()
    if not len(found):
        return np.empty(0, "S40")
    keys = np.sort(_composite([found[c].to_numpy(np.int64) for c in _COLUMNS]))
    at = np.arange(1, buckets) * len(keys) // buckets
    return np.unique(keys[at])


# Buckets

def multikey(columns: list[np.ndarray]) -> np.ndarray:
    """Order by the first column; where it ties by the next, and so on."""
    order = np.argsort(columns[0], kind="quicksort")
    tied = np.zeros(len(order), bool)  # with the one before, on all columns so far
    tied[1:] = columns[0][order[1:]] == columns[0][order[:-1]]
    for column in columns[1:]:
        part = tied.copy()
        part[:-1] |= tied[1:]
        at = np.flatnonzero(part)
        if not len(at):
            break
        group = np.cumsum(~tied[at])
        rows = order[at]
        values = column[rows]
        rows = rows[np.lexsort((values, group))]
        order[at] = rows
        same = column[order[1:]] == column[order[:-1]]
        tied[1:] &= same
    return order


_SPAN = "kind int, hash long, doc long, low long, high long"
COVERED, PROBE = 0, 1


def _spans(kind, hashes, docs, low, high) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(docs), kind, np.int32)), pa.array(hashes.view(np.int64)), pa.array(docs),
         pa.array(low), pa.array(high)], names=["kind", "hash", "doc", "low", "high"])


def _stretches(batches: Iterator[pa.RecordBatch], key: str, least: int = 1) -> Iterator[list[pa.RecordBatch]]:
    """Sorted rows in stretches of at least ``least`` rows that hold all rows of their keys."""
    held, rows, last = [], 0, None
    for batch in batches:
        keys = batch.column(key).to_numpy()
        if not len(keys):
            continue
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if last is not None and keys[0] != last:
            cuts = np.append(0, cuts)
        at = 0
        for cut in cuts:
            if rows + cut - at >= least:
                if cut > at:
                    held.append(batch.slice(at, cut - at))
                yield held
                held, rows, at = [], 0, cut
        held.append(batch.slice(at))
        rows, last = rows + len(keys) - at, keys[-1]
    if held:
        yield held


@freeing
def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring buckets, one after the other."""
    for held in _stretches(batches, "bucket"):
        columns = [np.concatenate(c) for c in zip(*([b.column(c).to_numpy() for c in _COLUMNS] for b in held))]
        yield from _bucket(columns)


def _bucket(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One bucket: bytes that are covered, and anchors to compare window by window."""
    w0, w1, w2, context = (c.view(np.uint64) for c in columns[:4])
    order = multikey([w0, w1, w2, context, *columns[4:]])
    w0, w1, w2, context, doc, place = (c[order] for c in (w0, w1, w2, context, *columns[4:]))
    low, high = place >> 8, (place >> 8) + (place & 255)
    new_key = np.ones(len(w0), bool)
    new_key[1:] = (w0[1:] != w0[:-1]) | (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
    new = new_key.copy()
    new[1:] |= context[1:] != context[:-1]
    first = np.flatnonzero(new)
    own = first[np.cumsum(new) - 1]  # the first place of each one's context
    covered = (doc != doc[own]) | (low != low[own])
    yield _spans(COVERED, np.zeros(int(covered.sum()), np.uint64), doc[covered], low[covered],
                 high[covered] + LENGTH)
    key = np.cumsum(new_key)[first] - 1
    several = np.bincount(key) > 1
    several[0] = several[-1] = True  # may go on in a neighbouring bucket
    probe = first[several[key]]
    hashed = mixed(w0[probe] + mixed(w1[probe] + mixed(w2[probe])))
    yield _spans(PROBE, hashed, doc[probe], low[probe], high[probe])


# Windows

@freeing
def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each anchor's windows."""
    for batch in batches:
        for doc, text, probes in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "probes"))):
            data = (text or "").encode()
            probes = [p for p in probes if p["high"] + LENGTH <= len(data)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p["hash"] for p in probes], pa.int64()), pa.array([doc] * len(probes), pa.int64()),
                 pa.array([p["low"] for p in probes], pa.int64()),
                 pa.array([data[p["low"]:p["high"] + LENGTH] for p in probes], pa.binary())],
                names=["hash", "doc", "low", "bytes"])


def _windows(batch: pa.RecordBatch | pa.Table):
    """Two hashes, document and place of every window of some contexts."""
    column = batch.column("bytes")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    n = np.diff(offsets) - LENGTH + 1
    owner = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    at = offsets[owner] + step
    low, doc, key = (batch.column(c).to_numpy() for c in ("low", "doc", "hash"))
    return Prefixes(data).spans(at, at + LENGTH), key[owner], doc[owner], low[owner] + step


def _comparer(most: int):
    """All windows of contexts, sorted by their leading bytes' hash, that start elsewhere before."""
    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _stretches(batches, "hash", most // 8):
            yield from _compared([_windows(b) for b in held])
    return run


def _compared(parts: list) -> Iterator[pa.RecordBatch]:
    hashed, key, doc, place = (np.concatenate(p) for p in zip(*parts))
    order = np.lexsort((place, doc, key, hashed))
    hashed, key, doc, place = hashed[order], key[order], doc[order], place[order]
    new = np.ones(len(doc), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (key[1:] != key[:-1])
    own = np.flatnonzero(new)[np.cumsum(new) - 1]
    covered = (doc != doc[own]) | (place != place[own])
    yield from _runs(doc[covered], place[covered])


def _runs(doc: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Windows of neighbouring starts as one span."""
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (place[1:] > place[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    yield _spans(COVERED, np.zeros(len(first), np.uint64), doc[first], place[first],
                 place[last] + LENGTH if len(first) else place[first])


@freeing
def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            hashed, key, doc, place = _windows(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashed.view(np.int64)), pa.array(key), pa.array(doc), pa.array(place)],
                names=["window", "hash", "doc", "place"])


def covered_windows(contexts: DataFrame) -> DataFrame:
    """Spans of the windows that start earlier in another context with the same leading bytes."""
    spark = contexts.sparkSession
    contexts = written(contexts, "contexts")
    frequent = contexts.groupBy("hash").count().where(F.col("count") > TOGETHER).select("hash")
    frequent = written(frequent, "frequent")
    few = among(contexts, frequent, "hash", keep=False)
    out = (few.repartition(TASKS * partitions(spark), "hash").sortWithinPartitions("hash")
           .mapInArrow(_comparer(TOGETHER), _SPAN))
    if frequent.isEmpty():
        return out
    many = among(contexts, frequent, "hash").mapInArrow(
        _window_rows, "window long, hash long, doc long, place long")
    first = many.groupBy("window", "hash").agg(F.min(F.struct("doc", "place")).alias("first"))
    later = many.join(first, ["window", "hash"]).where(F.struct("doc", "place") > F.col("first"))
    return out.unionByName(later.select(
        F.lit(COVERED).alias("kind"), F.lit(0).cast("long").alias("hash"), "doc",
        F.col("place").alias("low"), (F.col("place") + LENGTH).alias("high")))


# Texts

def covered_spans(docs: DataFrame) -> DataFrame:
    """doc, low, high: stretches of bytes that have an earlier copy; they may overlap."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    size = docs.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text").cast("long")).alias("bytes")).first()
    tasks = TASKS * partitions(spark)
    buckets = max(tasks, -(-(size.bytes or 0) // BUCKET_BYTES))
    rows = docs.mapInArrow(_anchor_rows(splitters(docs, buckets, size.rows, size.bytes or 0)), _ROW)
    task = F.floor(F.col("bucket") * F.lit(tasks).cast("long") / buckets).cast("int")
    found = written(
        rows.repartitionById(tasks, task).sortWithinPartitions("bucket").mapInArrow(_buckets, _SPAN), "spans")
    probes = found.where(F.col("kind") == PROBE).groupBy(F.col("doc").alias("doc_id")).agg(
        F.collect_list(F.struct("hash", "low", "high")).alias("probes"))
    probes = written(probes, "probes")
    texts = among(docs, probes, "doc_id").join(probes, "doc_id")
    contexts = texts.mapInArrow(_contexts, "hash long, doc long, low long, bytes binary")
    return (found.where(F.col("kind") == COVERED)
            .unionByName(covered_windows(contexts)).select("doc", "low", "high"))


def _cutter(names: list[str], out: tuple[str, str, str], as_text: bool):
    kind = pa.string() if as_text else pa.binary()

    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, spans = [], [], []
            for text, low, high in zip(*(batch.column(c).to_pylist() for c in ("text", "__low", "__high"))):
                data = np.frombuffer((text or "").encode(), np.uint8)
                depth = np.zeros(len(data) + 1, np.int32)
                np.add.at(depth, np.minimum(low, len(data)), 1)
                np.add.at(depth, np.minimum(high, len(data)), -1)
                gone = np.cumsum(depth[:-1]) > 0
                left = data[~gone].tobytes()
                kept.append(left.decode("utf-8", "ignore") if as_text else left)
                removed.append(int(gone.sum()))
                spans.append(int((gone[1:] & ~gone[:-1]).sum()) + int(len(gone) > 0 and gone[0]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(kept, kind), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64())], names=[*names, *out])
    return run


def deduplicated(docs: DataFrame, out: tuple[str, str, str] = ("kept", "n_removed", "n_spans"),
                 as_text: bool = False) -> DataFrame:
    """``docs`` with the bytes left of the text, how many were removed, and in how many runs.

    ``out`` names these columns; columns of ``docs`` with such names are replaced. With
    ``as_text`` the bytes left are text, and what a cut left of a character goes.
    """
    docs = docs.drop(*out)
    names = docs.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    spans = written(
        covered_spans(docs).groupBy(F.col("doc").alias("doc_id"))
        .agg(F.collect_list("low").alias("__low"), F.collect_list("high").alias("__high")), "cuts")
    nothing, kind = F.lit(0).cast("long"), "string" if as_text else "binary"
    whole = among(docs, spans, "doc_id", keep=False).select(
        *names, F.coalesce("text", F.lit("")).cast(kind).alias(out[0]),
        nothing.alias(out[1]), nothing.alias(out[2]))
    cut = among(docs, spans, "doc_id").join(spans, "doc_id").select(*names, "__low", "__high").mapInArrow(
        _cutter(names, out, as_text), f"{fields}, `{out[0]}` {kind}, `{out[1]}` long, `{out[2]}` long")
    return whole.unionByName(cut)
