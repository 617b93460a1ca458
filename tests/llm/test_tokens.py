from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from wardmart.llm import bpe, packing
from wardmart.llm.queries import BPE_RANKS, WORD_BPE

ODD = ["", None, " ", "\n\n  a", "don't  stop\n\n now", "ab cd İΣς é '' 's'S", "x" * 700,
       "日本語 テスト", "  \x1c a", "İstanbul ퟿", "á" * 40]


def documents(spark, texts, **extra):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for name in ("row", "piece", "ids", "tokens"):  # names that the operators use themselves
        df = df.selectExpr("*", f"'x' as {name}")
    return df


def checked(spark, texts):
    enc = bpe.encoding(BPE_RANKS, public_tokenizers.PATTERN)
    docs = documents(spark, texts)
    found = bpe.decode(bpe.encode(docs, BPE_RANKS, public_tokenizers.PATTERN), BPE_RANKS).collect()
    assert sorted(r.doc_id for r in found) == list(range(len(texts)))
    for r in found:
        text = texts[r.doc_id] or ""
        ids = enc.encode_ordinary(text)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.n_tokens == len(ids)
        assert bytes(r.decoded) == text.encode()


def test_odd_texts(spark):
    checked(spark, ODD)


def test_chunks_meet(spark, monkeypatch):
    """Texts of many chunks, some without a boundary for longer than the overlap."""
    rng = random.Random(5)
    parts = ["the ", "don't", "  ", "\n", "x" * 900, "1234 ", "été", " ", "!!", "\t\t\t" * 200, "日本"]
    texts = ["".join(rng.choice(parts) for _ in range(n)) for n in (20_000, 9_000, 70_000)]
    texts += ["a" * 70_000, " " * 70_000, "ab" * 20_000 + " " + "c" * 40_000]
    checked(spark, texts)


def test_repeated_rows_stay(spark):
    """Short and long texts, with equal and missing ids: a row each."""
    long = "word, and " * 5_000
    rows = [(1, "a b"), (1, "a b"), (2, long), (2, long), (None, long), (None, "a b"), (2, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    found = bpe.encode(docs, BPE_RANKS, public_tokenizers.PATTERN).collect()
    enc = bpe.encoding(BPE_RANKS, public_tokenizers.PATTERN)
    assert sorted((str(r.doc_id), r.n_tokens) for r in found) == sorted(
        (str(i), len(enc.encode_ordinary(t))) for i, t in rows)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(docs, BPE_RANKS, public_tokenizers.PATTERN).count() == 0
    assert packing.pack(packing.pieces(docs, WORD_BPE)).count() == 0


def test_word_ids_are_the_library_s():
    rng = random.Random(3)
    texts = [t or "" for t in ODD]
    texts += ["Word. word, WORD.. É. été, ª º. ß, a\x01b \x01 .", "\x01", "x\x01", "., . ,", "don't. it's,"]
    texts += ["".join(chr(rng.choice((rng.randrange(32, 0x250), rng.randrange(32, 127))))
                      for _ in range(60)) for _ in range(600)]
    t = packing.tokenizer(WORD_BPE)
    expected = [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    assert packing.WordIds(WORD_BPE).encode(texts) == expected


def test_added_tokens_as_the_library_has_them():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(WORD_BPE)
    marker = "<|endoftext|>"
    texts = [f"end {marker} start", marker, f"a{marker}b, c.", f"日 {marker}", marker.upper(), f"End {marker.upper()} {marker}.",
             "<|startoftext|>x", f"x\x01{marker}", "<|end of|> text", f"É{marker.title()} ."]
    expected = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert len(expected[0]) == 3 * 4
    assert packing.WordIds(WORD_BPE).encode(texts) == expected
    assert packing.WordIds(WORD_BPE).encode(texts[::-1]) == expected[::-1]


def test_best_fit_against_search():
    rng = random.Random(1)
    for capacity in (1, 7, 64, 100):
        lengths = np.array([rng.randint(1, capacity) for _ in range(300)])
        sequence, offset = packing.best_fit(lengths, capacity)
        room: dict[int, int] = {}
        for i in np.argsort(-lengths, kind="stable"):
            n = int(lengths[i])
            fits = [r for r in room.values() if r >= n]
            before = room.get(int(sequence[i]), capacity)
            assert before == (min(fits) if fits else capacity)
            assert offset[i] == capacity - before
            room[int(sequence[i])] = before - n


def test_pieces_cover_and_pack(spark):
    texts = [*ODD, "word " * 9000, "a b c " * 500, *["tail text"] * 5]
    docs = documents(spark, texts)
    found = packing.pack(packing.pieces(docs, WORD_BPE, capacity=256), capacity=256, bundle=7).collect()
    t = packing.tokenizer(WORD_BPE)
    by_doc, by_sequence = {}, {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, text in enumerate(texts):
        rows = sorted(by_doc[i], key=lambda r: r.start)
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        assert b"".join(r.ids for r in rows) == np.array(ids, "<u4").tobytes()
        assert [r.start for r in rows] == list(range(0, len(ids), 256))
        assert {r.doc_tokens for r in rows} == {len(ids)}
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256


@pytest.mark.parametrize("name", ["op3_byte_bpe", "op9_packing"])
def test_queries(spark, name):
    from conftest import TESTDATA

    from wardmart.llm.queries import QUERIES

    sf = str(TESTDATA / "sf0.001")
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES[name](spark, sf).collect()
    if name == "op3_byte_bpe":
        enc = bpe.encoding(BPE_RANKS, public_tokenizers.PATTERN)
        assert sorted(r.doc_id for r in rows) == sorted(texts)
        for r in rows:
            ids = np.array(enc.encode_ordinary(texts[r.doc_id]), "<u4").tobytes()
            assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
            assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        return
    t = packing.tokenizer(WORD_BPE)
    ids = {d: np.array([*t.encode(x, add_special_tokens=False).ids, 2], "<u4") for d, x in texts.items()}
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())
        assert r.doc_tokens == len(ids[r.doc_id])
    full = {}
    for r in rows:
        full[r.sequence_id] = full.get(r.sequence_id, 0) + r.length
    assert sum(4096 - n for n in full.values()) < 0.05 * 4096 * len(full)
