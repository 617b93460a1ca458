"""Byte-level BPE encoding by overlapping chunks, and decoding.

A text longer than ``CHUNK`` characters is cut into chunks that overlap; the chunks are
pre-tokenised in parallel, each from its own start. Where the pre-token boundaries of two
neighbours agree inside their overlap, and the character before is no white space, both
have fallen into step: the text is cut there. Neighbours that never agree (one very long
pre-token) are joined. Each piece between cuts is then encoded by itself, also in parallel,
and the ids are put in a row. A shorter text is its own single piece.

Null and empty texts have no ids. Repeated rows stay repeated; other columns are dropped.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 32_768
OVERLAP = 512


@cache
def encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@cache
def _pieces_of_ids(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes in a row, and start and length of each id's."""
    with open(path, "rb") as lines:
        ranks = {int(r): base64.b64decode(t) for t, r in map(bytes.split, lines)}
    tokens = [ranks.get(i, b"") for i in range(max(ranks) + 1)]
    lengths = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths


def _binaries(parts: list) -> pa.Array:
    return pa.array(parts, pa.binary())


def _encoder(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path, pattern).encode_to_numpy
        for batch in batches:
            ids = [encode(t, disallowed_special=()) if t else np.empty(0, "<u4")
                   for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "row", "piece")]
                + [pa.array([len(i) for i in ids], pa.int64()),
                   _binaries([i.astype("<u4", copy=False).tobytes() for i in ids])],
                names=["doc_id", "row", "piece", "n_tokens", "ids"])
    return run


def _chunker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "row", "chunk", "text"]
    for batch in batches:
        for doc, row, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "text"))):
            for k, at in enumerate(range(0, len(text), CHUNK)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc], batch.schema.field("doc_id").type), pa.array([row], pa.int64()),
                     pa.array([k], pa.int64()), pa.array([text[at:at + CHUNK + OVERLAP]])],
                    names=names)


def _boundary_finder(pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        tokens = regex.compile(pattern)
        for batch in batches:
            heads, tails = [], []
            for text in batch.column("text").to_pylist():
                ends = [m.end() for m in tokens.finditer(text) if not text[m.end() - 1].isspace()]
                # The last one may be cut short by the end of the chunk.
                heads.append([e for e in ends[:-1] if e < OVERLAP])
                tails.append([e - CHUNK for e in ends[:-1] if e >= CHUNK])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("chunk"),
                 pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))],
                names=["row", "chunk", "head", "tail"])
    return run


def stitched(chunks: DataFrame, pattern: str) -> DataFrame:
    """Pieces of texts from their chunks: doc_id, row, piece, text."""
    marks = chunks.mapInArrow(
        _boundary_finder(pattern), "row long, chunk long, head array<long>, tail array<long>")
    order = Window.partitionBy("row").orderBy("chunk")
    agreed = F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
    cuts = (
        marks.select("row", "chunk", agreed.alias("to"))
        .withColumn("from", F.lag("to").over(order))
        .withColumn("piece", F.count("from").over(order)))
    part = F.substring(
        "text", F.coalesce("from", F.lit(0)).cast("int") + 1,
        (F.coalesce("to", F.lit(0)) + CHUNK - F.coalesce("from", F.lit(0))).cast("int"))
    last = F.col("chunk") == F.max("chunk").over(Window.partitionBy("row"))
    cuts = cuts.withColumn("last", last)
    return (
        chunks.join(cuts, ["row", "chunk"])
        .withColumn("part", F.when(F.col("last"), F.expr("substring(text, int(coalesce(`from`, 0)) + 1)"))
                    .otherwise(part))
        .groupBy("doc_id", "row", "piece")
        .agg(F.array_sort(F.collect_list(F.struct("chunk", "part"))).alias("parts"))
        .select("doc_id", "row", "piece", F.array_join("parts.part", "").alias("text")))


def _joiner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [b"".join(p["ids"] for p in parts) for parts in batch.column("parts").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), _binaries(ids)],
            names=["doc_id", "n_tokens", "ids"])


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit) of every text.

    ``path`` names a file of ranks that every executor has, ``pattern`` the pre-tokens.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    plain = docs.select("doc_id", F.monotonically_increasing_id().alias("row"),
                        F.coalesce("text", F.lit("")).alias("text"))
    long = F.length("text") > CHUNK
    fields = f"doc_id {kind}, row long, piece long, n_tokens long, ids binary"
    run = _encoder(path, pattern)
    short = plain.where(~long).withColumn("piece", F.lit(0).cast("long")).mapInArrow(run, fields)
    chunks = (
        plain.where(long)
        .mapInArrow(_chunker, f"doc_id {kind}, row long, chunk long, text string")
        .repartition("row", "chunk"))
    pieces = stitched(chunks, pattern).mapInArrow(run, fields)
    whole = (
        pieces.groupBy("doc_id", "row")
        .agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("parts"))
        .select("doc_id", "parts")
        .mapInArrow(_joiner, f"doc_id {kind}, n_tokens long, ids binary"))
    return short.select("doc_id", "n_tokens", "ids").unionByName(whole)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` and ``decoded``: the bytes of its ids in a row (null: none)."""
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, starts, lengths = _pieces_of_ids(path)
        for batch in batches:
            out = []
            for raw in batch.column("ids"):
                ids = np.frombuffer(raw.as_buffer() or b"", "<u4")
                n = lengths[ids]
                ends = np.cumsum(n)
                at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[ids] - ends + n, n)
                out.append(data[at].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [_binaries(out)], names=[*names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{fields}, decoded binary")
