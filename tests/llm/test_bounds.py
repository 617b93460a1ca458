"""What a task holds, whatever the data, and the pipeline's stages on odd rows."""

from __future__ import annotations

import re
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from conftest import ROOT
from pyspark.sql import functions as F

import corpus_pipeline
from wardmart.llm import packing, secrets, suffix_dedup

STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, __extra string"
ENGLISH = "the quick brown fox jumps over the lazy dog and then it sleeps under the old tree by the river all day"


# Suffixes

def batches(keys, size):
    return [pa.RecordBatch.from_arrays([pa.array(keys[i:i + size]), pa.array(range(i, min(i + size, len(keys))))], names=["k", "n"])
            for i in range(0, len(keys), size)]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
@pytest.mark.parametrize("least", [1, 4, 1000])
def test_stretches(size, least):
    """All rows of a key lie in one stretch; a stretch ends as soon as it has enough."""
    rng = np.random.default_rng(size)
    keys = np.sort(rng.integers(0, 12, 40)).tolist()
    found = [[r for b in held for r in b.column("n").to_pylist()]
             for held in suffix_dedup._stretches(iter(batches(keys, size)), "k", least)]
    assert [x for part in found for x in part] == list(range(40))
    for a, b in zip(found, found[1:]):
        assert keys[a[-1]] != keys[b[0]] and len(a) >= least
        first_of_last = keys.index(keys[a[-1]])
        assert first_of_last - a[0] < least  # without its last key it would have been too short
    assert list(suffix_dedup._stretches(iter(batches([], 3)), "k")) == []


def test_buckets_follow_the_bytes(spark, monkeypatch):
    """Four times the text has four times the buckets: what one of them holds stays alike."""
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 1 << 16)
    rng = np.random.default_rng(3)
    largest = []
    for n in (1_000, 4_000):
        texts = [(i, "".join(map(chr, rng.integers(97, 123, 2_000)))) for i in range(n)]
        docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
        buckets = -(-2_000 * n // suffix_dedup.BUCKET_BYTES)
        bounds = suffix_dedup.splitters(docs, buckets, n, 2_000 * n)
        rows = docs.mapInArrow(suffix_dedup._anchor_rows(bounds), suffix_dedup._ROW)
        sizes = [r["count"] for r in rows.groupBy("bucket").count().collect()]
        assert len(sizes) == buckets
        largest.append(max(sizes))
        assert max(sizes) < 3 * np.median(sizes)
    assert largest[1] < 1.5 * largest[0]


def test_many_buckets_a_task_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(5)
    passage = "".join(map(chr, rng.integers(97, 123, 300)))
    texts = []
    for i in range(120):
        own = "".join(map(chr, rng.integers(97, 123, int(rng.integers(0, 900)))))
        texts.append((i, own + passage[:int(rng.integers(50, 300))] if i % 2 else passage + own))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    plain = {r.doc_id: (bytes(r.kept), r.n_removed, r.n_spans) for r in suffix_dedup.deduplicated(docs).collect()}
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 256)
    monkeypatch.setattr(suffix_dedup, "TOGETHER", 5)
    assert {r.doc_id: (bytes(r.kept), r.n_removed, r.n_spans)
            for r in suffix_dedup.deduplicated(docs).collect()} == plain
    assert sum(x[1] for x in plain.values()) > 5_000


# Packing

def test_equal_and_missing_ids_spread_over_bundles(spark):
    """Pieces of one id, or of none, are dealt like any others; each is placed once."""
    rows = [(None, 0, 1 + i % 50) for i in range(6_000)] + [(7, 0, 1 + i % 50) for i in range(6_000)]
    found = packing.pack(spark.createDataFrame(rows, "doc_id long, start long, length long").repartition(5), 64, 1_000)
    placed = found.withColumn("bundle", F.shiftright("sequence_id", 32)).collect()
    sizes = np.bincount([r.bundle for r in placed])
    assert len(placed) == 12_000 and len(sizes) == 12 and sizes.max() < 1_300
    taken = sorted((r.sequence_id, r.offset, r.length) for r in placed)
    for (s, at, n), (t, next_at, _) in zip(taken, taken[1:]):
        assert next_at == at + n if s == t else next_at == 0


# Pipeline

def frame(spark, rows):
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "x") for r in rows], COLUMNS).repartition(3)


@pytest.mark.parametrize("stage", STAGES)
def test_empty_table(spark, stage):
    docs = frame(spark, [])
    found = STAGES[stage](spark, docs, "")
    assert found.count() == 0
    if stage != "pack":
        assert found.columns == docs.columns


def odd_rows():
    long = " ".join(f"{ENGLISH} {i}" for i in range(3_000))
    return [(1, ENGLISH, "en", "a"), (1, ENGLISH, "en", "a"), (None, ENGLISH + " or so", None, None), (None, None, None, None),
            (3, None, "en", "b"), (4, "", "en", "b"), (5, long, None, "c")]


@pytest.mark.parametrize("stage", STAGES)
def test_odd_rows(spark, stage):
    """Nulls, empty and long texts, repeated rows and further columns crash no stage."""
    docs = frame(spark, odd_rows())
    found = STAGES[stage](spark, docs, "")
    rows = found.collect()
    if stage != "pack":
        assert found.columns == docs.columns and {r["__extra"] for r in rows} == {"x"}
    if stage == "pack":
        assert sum(1 for r in rows if r.start == 0) == 7  # an empty text is its end token


def test_one_of_equal_rows_stays(spark):
    """Equal in doc_id and text, with or without a doc_id; a row without one stands behind the others."""
    other = " ".join(f"word{i}" for i in range(60))
    rows = [(9, ENGLISH, "en", "a"), (9, ENGLISH, "en", "b"), (None, ENGLISH, None, None), (None, ENGLISH, None, None),
            (None, other, None, None), (None, other, "en", None), (2, other + " more", None, None), (5, "alone " + ENGLISH[:40], None, None),
            (6, None, None, None), (6, None, None, None), (None, None, None, None), (None, None, None, None)]
    found = STAGES["near_duplicates"](spark, frame(spark, rows), "").collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(
        [(9, ENGLISH), (2, other + " more"), (5, "alone " + ENGLISH[:40]), (6, None), (None, None)], key=str)


def test_emptied_texts_go(spark):
    """A text that repeats as a whole leaves nothing to pack; one that was empty before stays as it is."""
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(1, passage, "en", "a"), (2, passage, "en", "a"), (3, "", "en", "a"), (4, "own start " + passage, "en", "a")]
    found = {r.doc_id: r for r in STAGES["repeats"](spark, frame(spark, rows), "").collect()}
    assert found.keys() == {1, 3, 4}
    assert found[1].text == passage and found[4].text == "own start " and found[4].n_chars == 10


# Secrets

_LARGE = """
import base64, gzip, resource, sys
sys.path.insert(0, {root!r})
body = b"." * 23_500_000 + b" password=hunter2hunter2 " + b"." * 23_500_000
inside = base64.b64encode(gzip.compress(base64.b64encode(body), mtime=0)).decode()
del body
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
from wardmart.llm import secrets
base, spans = secrets.spans("see " + inside + " there")
assert base == [] and spans == [(4, 4 + len(inside.rstrip("=")), "assign")], spans
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""


def test_a_large_body_takes_little_memory():
    """Base64 of 63 MB inside a compressed body inside base64, at the real block size: the worker
    stays below 600 MB, and the secret maps to the whole body."""
    done = subprocess.run([sys.executable, "-c", _LARGE.format(root=ROOT)], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 600


@pytest.mark.parametrize("chunk", [1, 5, 64, 1 << 20])
def test_runs_over_chunks(monkeypatch, chunk):
    monkeypatch.setattr(secrets, "CHUNK", chunk)
    rng = np.random.default_rng(chunk)
    for _ in range(60):
        data = bytes(rng.choice(list(b"ab0 -"), size=int(rng.integers(0, 90)), p=[.4, .2, .3, .05, .05]).astype(np.uint8))
        for least in (1, 4, 24):
            expected = [m.span() for m in re.finditer(rb"[0-9a-f]{%d,}" % least, data)]
            assert secrets.long_runs(data, least) == expected


def test_layers_map_back():
    """Every byte of an inner layer stands for characters that hold it, also through several layers."""
    text = "é %41%zz\\u0042&#67;D password%3Dhunter2hunter2 ü"
    data = text.encode()
    layer = next(secrets.unwrapped(secrets.Layer(data)))
    assert layer.data == data.replace(b"%41", b"A").replace(b"%3D", b"=")
    inner = next(x for x in secrets.unwrapped(layer) if x.data != layer.data)
    for found, source in ((b"A", b"%41"), (b"B", b"\\u0042"), (b"C", b"&#67;"), (b"D p", b"D p"), (b"=", b"%3D")):
        at = inner.data.index(found)
        low, high = inner.span(at, at + len(found))
        assert data[low:high] == source
