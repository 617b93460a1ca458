"""What the operators share: batches as bytes, tables in the shared folder, checked broadcasts."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmart.sources.shared import shared_folder

#: Most rows of a table of ids that is sent to every executor (8 bytes each in Spark's own
#: long map, about 30 MB). Larger tables are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Bytes of text that numpy looks at in one go.
SLICE_BYTES = 1 << 18


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the folder all executors share; cuts its lineage."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_REMEMBERED: dict = {}


def remembered(key, make):
    """What a worker keeps from task to task under ``key``; it keeps one such thing at a time."""
    if key not in _REMEMBERED:
        _REMEMBERED.clear()
        _REMEMBERED[key] = make()
    return _REMEMBERED[key]


def forget() -> None:
    """Frees what an earlier operator's tasks kept in this worker."""
    _REMEMBERED.clear()
    release()


def release() -> None:
    """Gives memory that is free in this worker back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def freeing(task: Task) -> Task:
    """``task`` as one that leaves nothing behind in its worker, which may wait long for the next."""
    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        yield from task(batches)
        release()
    return run


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def among(df: DataFrame, ids: DataFrame, key: str, keep: bool = True) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``ids`` (or is not, without ``keep``).

    ``ids`` is broadcast if it is counted to be small, else both sides are shuffled.
    """
    ids = ids.select(key).distinct()
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    return df.join(ids, key, "left_semi" if keep else "left_anti")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column (null: empty) and where each row starts, and the end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    low, high = int(starts[0]), int(starts[-1])
    values = np.frombuffer(data, np.uint8)[low:high] if high > low else np.empty(0, np.uint8)
    return values, starts - low


def slices(starts: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``most`` bytes together; a longer row stands alone."""
    first, rows = 0, len(starts) - 1
    while first < rows:
        last = int(np.searchsorted(starts, starts[first] + most, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit changes about half of the output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_words(n: int, seed: int) -> np.ndarray:
    """``n`` fixed 64-bit values."""
    shift = np.uint64(seed * 0xD1342543DE82EF95 % (1 << 64))
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + shift)


#: One value per byte, and an odd base and its inverse mod 2**64 for polynomial hashes.
BYTE_VALUES = random_words(256, 11)
BASE = np.uint64(0x2545F4914F6CDD1D)
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Prefixes:
    """Hashes of any stretches of one byte array, from sums of byte value times power."""

    def __init__(self, data: np.ndarray):
        terms = BYTE_VALUES[data]
        terms *= powers(BASE, len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])
        self.down = powers(UNBASE, len(data) + 1)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return mixed(raw + (end - start).astype(np.uint64) * BYTE_VALUES[0])


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all rows: runs without space or 0x09-0x0D. Start, end, and row of each."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = blank[1:] != blank[:-1]
    edge[starts] = True
    cuts = np.flatnonzero(edge)
    begin, end = cuts[:-1], cuts[1:]
    word = ~blank[begin] if len(data) else np.zeros(0, bool)
    begin, end = begin[word], end[word]
    return begin, end, np.searchsorted(starts, begin, "right") - 1
