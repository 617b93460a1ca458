"""The vocabulary's transducers and the source divergence audit against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from wardmart.llm import divergence, queries
from wardmart.llm.vocabulary import Tally, Transducer, terms

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w).encode() for w in WORD.findall(text or "")]


def test_terms(monkeypatch):
    texts = ["", "Ab cD9é—x  ÄÖ", "a" * 50, "x1y2z3 " * 20, "日本語 Text\x00end", "\x7fA_b[c"]
    for piece in (1, 7, 1 << 20):
        monkeypatch.setattr("wardmart.llm.vocabulary.PIECE", piece)
        for text in texts:
            assert [w for some in terms(text.encode()) for w in some] == plain_terms(text)


@pytest.mark.parametrize("seed", range(4))
def test_transducer(seed):
    r = random.Random(seed)
    words = sorted({bytes(r.choice(b"abc\xc3\xff") for _ in range(r.randint(1, 6))) for _ in range(400)})
    t = Transducer.of(words)
    assert t.ordinals(words).tolist() == list(range(len(words)))
    assert [t.word(i) for i in range(len(words))] == words
    others = [w + b"z" for w in words] + [b"a" * 40, b"\x01"]
    assert all(t.ordinals([w for w in others if w not in words]) == -1)


def test_transducer_is_minimal():
    """As many states as the words have different sets of endings."""
    words = sorted({a + b + c for a in (b"x", b"yy", b"z") for b in (b"", b"m", b"no") for c in (b"s", b"ed", b"ing")})
    starts = {w[:i] for w in words for i in range(len(w) + 1)}
    endings = {frozenset(w[len(s):] for w in words if w.startswith(s)) for s in starts}
    assert len(Transducer.of(words).final) == len(endings)


def test_empty_transducer():
    t = Transducer.of([])
    assert t.ordinals([b"a"]).tolist() == [-1] and t.ordinals([]).tolist() == []


def test_tally_hands_on_in_time():
    tally = Tally(3, 100)
    tally.add(("k", 1), tally.numbered("k", b"a a b"))
    (key, numbers, n), = tally.counted()
    assert key == ("k", 1) and {tally.words("k")[i]: c for i, c in zip(numbers, n)} == {b"a": 2, b"b": 1}
    assert not tally.full
    tally.add(("j", 1), tally.numbered("j", b"a"))
    assert tally.full and tally.words("j") == [b"a"] and tally.words("none") == []
    tally.clear()
    tally.numbered("k", b" " * 100)
    assert tally.full


def audited(rows, min_docs, most):
    """The whole contract over lists."""
    docs = [tuple(x or "" for x in row) for row in rows]
    seen, out = Counter(), []
    for text, lang, _ in docs:
        seen.update((lang, w) for w in set(plain_terms(text)))
    kept = {}
    for (lang, word), n in seen.items():
        if n >= min_docs:
            kept.setdefault(lang, []).append(word)
    groups = {(lang, source): Counter() for _, lang, source in docs}
    for text, lang, source in docs:
        groups[lang, source].update(w for w in plain_terms(text) if w in set(kept.get(lang, [])))

    def shares(counter, words):
        total = sum(counter.values())
        return {w: 1 + 1000000000 * (counter[w] + 2) // (total + 2 * len(words)) for w in words}

    def apart(p, q):
        return (p - q) ** 2 // (p + q)

    for (lang, source), counter in groups.items():
        words = kept.get(lang, [])
        p = shares(counter, words)
        pairs = []
        for (other_lang, other), c in groups.items():
            if other_lang == lang and other != source:
                q = shares(c, words)
                pairs.append((-sum(apart(p[w], q[w]) for w in words), other.encode()))
        q = shares(sum((c for (x, _), c in groups.items() if x == lang), Counter()), words)
        found = [(-apart(p[w], q[w]), w) for w in words if counter[w] and p[w] > q[w]]
        for part, its in (("pair", sorted(pairs)), ("term", sorted(found)[:most])):
            out += [(lang, source, part, item.decode(), -v, i) for i, (v, item) in enumerate(its, 1)]
    return sorted(out)


def corpus(seed=0, n=120):
    """Two large languages, one without kept terms, nulls, empty and repeated rows, tied terms."""
    r = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "délta", "日本", "zeta", "eta", "É"] + [f"w{c}" for c in "abcdefghij"]
    rows = []
    for _ in range(n):
        source = r.choice(["s1", "s2", "s3", "ß", None])
        text = " ".join(r.choices(words, [r.random() if source == "s1" else 1 for _ in words], k=r.randint(0, 30)))
        rows.append((text, r.choice(["en", "fr"]), source))
    rows += [rows[0]] * 5 + [(None, "en", "s9"), ("", None, None), ("one two", "xx", "s1"), ("three", "xx", "s2")]
    rows += [("tie1 tieA same", "en", f"t{i}") for i in range(3)]
    return rows + [("x" * 5000 + " alpha " * 4000, "fr", "long")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string").selectExpr(
        "*", "'x' as shard", "1 as ordinal", "'y' as item", "2 as rank", "'z' as __turn").repartition(5)


@pytest.mark.parametrize("carried, shard, block, tile", [
    (1 << 26, 1 << 16, 2048, 256), (0, 1 << 16, 2048, 256), (1 << 26, 3, 4, 2), (0, 3, 4, 2)])
def test_audit(spark, monkeypatch, carried, shard, block, tile):
    for name, value in {"CARRIED_BYTES": carried, "SHARD_TERMS": shard, "BLOCK": block, "TILE": tile,
                        "TALLY_TERMS": 50}.items():
        monkeypatch.setattr(divergence, name, value)
    rows = corpus()
    found = divergence.audit(frame(spark, rows), min_docs=3, most=4).collect()
    assert sorted(map(tuple, found)) == audited(rows, 3, 4)
    assert {r.lang for r in found if r.part == "pair"} >= {"en", "fr", "xx"}


def test_no_term_is_kept(spark):
    rows = [("a b", "en", "s1"), ("c", "en", "s2")]
    found = divergence.audit(frame(spark, rows), min_docs=3)
    assert sorted(map(tuple, found.collect())) == [
        ("en", "s1", "pair", "s2", 0, 1), ("en", "s2", "pair", "s1", 0, 1)]


def test_empty_table(spark):
    found = divergence.audit(frame(spark, []))
    assert found.count() == 0
    assert found.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"),
                            ("value", "bigint"), ("rank", "int")]


def test_query_reads_only_three_columns(spark):
    sf = "/root/testdata/sf0.001"
    found = queries.QUERIES["op11_divergence"](spark, sf)
    docs = [(r.text, r.lang, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, found.collect())) == audited(docs, 10, 10)
