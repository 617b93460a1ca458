"""Language of a text, by unigram pieces summed over all segmentations of each word.

Every language has a probability for each piece of a fixed public vocabulary. A word's
probability under a language is the sum over all ways to write it as a row of pieces, by the
forward algorithm; a text's is the product over its words (runs of letters and their marks, lower
case, of any length; dashes, quotes and other signs of any script end them). Sums are kept as
logs, as a long run has far less than the least double. Probabilities are fitted by expectation
maximisation on at most ``TRAIN_DOCS`` labelled documents a language, then every text is scored
whole, however long.

Texts that are null or hold no letter are ``und`` with score 0; so is everything if nothing
was labelled. A tie goes to the language that sorts first. Repeated rows are scored each, and
each counts in the fit. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmart.llm.common import Prefixes, freeing, release, remembered, slices, utf8, written

#: Most documents of one language that the model learns from.
TRAIN_DOCS = 4000
ROUNDS = 3
#: Weight of all languages' common probabilities in each language's own, in pieces seen.
SHARED_WEIGHT = 1000.0
#: Words whose scores a worker remembers.
KNOWN_WORDS = 400_000
UNDETERMINED = "und"


class Vocabulary:
    """Pieces of a rank file that are lower-case letters, and all single bytes."""

    def __init__(self, path: str):
        pieces = {bytes([b]) for b in range(256)}
        with open(path, "rb") as lines:
            for line in lines:
                token = base64.b64decode(line.split()[0]).removeprefix(b" ")
                if len(token) > 1 and all(97 <= b < 123 or b >= 128 for b in token):
                    pieces.add(token)
        pieces = sorted(pieces)
        self.longest = max(map(len, pieces))
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        starts = ends - np.array([len(p) for p in pieces])
        hashes = Prefixes(data).spans(starts, ends)
        self.ids = np.argsort(hashes)
        self.hashes = hashes[self.ids]
        assert len(np.unique(hashes)) == len(hashes)
        # Rules out most stretches before the search: whether any piece has these top bits.
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self.hashes >> np.uint64(42)] = True

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece of each hash, or -1."""
        out = np.full(len(hashes), -1, np.int64)
        at = np.flatnonzero(self.maybe[hashes >> np.uint64(42)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        hit = self.hashes[place] == hashes[at]
        out[at[hit]] = self.ids[place[hit]]
        return out


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@dataclass
class Lattice:
    """All pieces inside some words, which lie one after the other with a gap of one state."""

    words: int
    first: np.ndarray  # state before each word's first byte
    last: np.ndarray  # state after its last
    start: np.ndarray  # state before each found piece; sorted by the offset of its end, then by word
    end: np.ndarray
    piece: np.ndarray
    word: np.ndarray
    steps: list[tuple[int, int]]  # found pieces that end at the same offset


def lattice(prefixes: Prefixes, begin: np.ndarray, end: np.ndarray, vocab: Vocabulary) -> Lattice:
    n = end - begin
    first = np.cumsum(n + 1) - (n + 1)
    kept = []
    for size in range(1, vocab.longest + 1):
        fits = np.flatnonzero(n >= size)
        if not len(fits):
            break
        per = n[fits] - size + 1
        word = np.repeat(fits, per)
        offset = np.arange(len(word)) - np.repeat(np.cumsum(per) - per, per)
        at = begin[word] + offset
        piece = vocab.find(prefixes.spans(at, at + size))
        hit = piece >= 0
        kept.append((word[hit], offset[hit], np.full(int(hit.sum()), size), piece[hit]))
    if not kept:
        empty = np.empty(0, np.int64)
        return Lattice(0, empty, empty, empty, empty, empty, empty, [])
    word, offset, size, piece = (np.concatenate(x) for x in zip(*kept))
    order = np.lexsort((word, offset + size))
    word, offset, size, piece = word[order], offset[order], size[order], piece[order]
    ends = offset + size
    cuts = np.searchsorted(ends, np.arange(1, int(n.max()) + 2))
    return Lattice(len(n), first, first + n, first[word] + offset, first[word] + ends, piece, word,
                   list(zip(cuts[:-1].tolist(), cuts[1:].tolist())))


def _summed(logs: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each state of a sorted row of states, and the log of the sum of what belongs to it."""
    at = np.flatnonzero(np.diff(states, prepend=-1))
    top = np.maximum.reduceat(logs, at)
    n = np.diff(np.append(at, len(states)))
    return states[at], top + np.log(np.add.reduceat(np.exp(logs - np.repeat(top, n, axis=0)), at))


def log_forward(lat: Lattice, logs: np.ndarray) -> np.ndarray:
    """Log probability of reaching each state, for every column of the found pieces' ``logs``."""
    out = np.full((int(lat.last[-1]) + 1, logs.shape[1]), -np.inf)
    out[lat.first] = 0.0
    for a, b in lat.steps:
        states, sums = _summed(out[lat.start[a:b]] + logs[a:b], lat.end[a:b])
        out[states] = sums
    return out


def forward(lat: Lattice, p: np.ndarray) -> np.ndarray:
    """Probability of reaching each state, for every column of the pieces' probabilities ``p``."""
    return np.exp(log_forward(lat, np.log(p)))


def expected(lat: Lattice, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """How often each found piece is used, with ``weight`` copies of each word; p: one column."""
    logs = np.log(p)
    before = log_forward(lat, logs[:, None])[:, 0]
    after = np.full_like(before, -np.inf)
    after[lat.last] = 0.0
    offset = lat.start - lat.first[lat.word]
    order = np.lexsort((lat.word, offset))
    cuts = np.searchsorted(offset[order], np.arange(int(offset.max()) + 2))
    for a, b in zip(cuts[-2::-1].tolist(), cuts[:0:-1].tolist()):
        at = order[a:b]
        states, sums = _summed(logs[at] + after[lat.end[at]], lat.start[at])
        after[states] = sums
    total = before[lat.last]
    return np.exp(before[lat.start] + logs + after[lat.end] - total[lat.word]) * weight[lat.word]


#: Characters beyond ASCII that are neither letters nor marks on them.
_NO_LETTERS = regex.compile(r"[^\x00-\x7F\p{L}\p{M}]+")


def letter_runs(data: np.ndarray, starts: np.ndarray):
    """Begin, end and row of each run of a-z and bytes above 127 in texts from ``_lowered``."""
    inside = ((data >= 97) & (data < 123)) | (data >= 128)
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[starts] = True
    cuts = np.flatnonzero(edge)
    begin, end = cuts[:-1], cuts[1:]
    word = inside[begin] if len(data) else np.zeros(0, bool)
    begin, end = begin[word], end[word]
    return begin, end, np.searchsorted(starts, begin, "right") - 1


def _lowered(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts in lower case, where only letters and marks are beyond ASCII."""
    lower = [(t or "").lower() for t in texts]
    return utf8(pa.array([t if t.isascii() else _NO_LETTERS.sub(" ", t) for t in lower], pa.string()))


class Model:
    def __init__(self, path: str, languages: list[str], p: np.ndarray, prior: np.ndarray):
        self.path, self.languages, self.p, self.prior = path, languages, p, prior
        self.logs = np.log(p)
        self.name = uuid.uuid4().hex

    def _known(self) -> dict:
        """Words scored before in this worker: sorted hashes, and their rows of logs."""
        return remembered(("language", self.name), lambda: {
            "hashes": np.empty(0, np.uint64), "logs": np.empty((0, len(self.languages)))})

    def _words(self, prefixes: Prefixes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Log probability of each word; those scored before are looked up by their hash."""
        hashes, one, which = np.unique(
            prefixes.spans(begin, end), return_index=True, return_inverse=True)
        store = self._known()
        at = np.searchsorted(store["hashes"], hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(store["hashes"])
        known[inside] = store["hashes"][at[inside]] == hashes[inside]
        logs = np.empty((len(hashes), len(self.languages)))
        logs[known] = store["logs"][at[known]]
        new = ~known
        if new.any():
            lat = lattice(prefixes, begin[one[new]], end[one[new]], vocabulary(self.path))
            logs[new] = log_forward(lat, self.logs[lat.piece])[lat.last]
            if len(store["hashes"]) < KNOWN_WORDS:
                store["hashes"] = np.insert(store["hashes"], at[new], hashes[new])
                store["logs"] = np.insert(store["logs"], at[new], logs[new], axis=0)
        return logs[which]

    def log_scores(self, texts: list) -> np.ndarray:
        """Log probability of each text under each language, with the prior."""
        data, starts = _lowered(texts)
        out = np.tile(np.log(self.prior), (len(texts), 1))
        for i, j in slices(starts):
            part, at = data[starts[i]:starts[j]], starts[i:j + 1] - starts[i]
            begin, end, row = letter_runs(part, at)
            if len(begin):
                logs = self._words(Prefixes(part), begin, end)
                for c in range(out.shape[1]):
                    out[i:j, c] += np.bincount(row, logs[:, c], j - i)
        return out


@freeing
def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        names = sorted(set(langs))
        data, starts = _lowered(batch.column("text").to_pylist())
        begin, end, row = letter_runs(data, starts)
        if not len(begin):
            continue
        lang = np.array([names.index(x) for x in langs])[row]
        hashes = Prefixes(data).spans(begin, end)
        order = np.lexsort((hashes, lang))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (lang[order][1:] != lang[order][:-1])
        at = np.flatnonzero(new)
        one = order[at]
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[x] for x in lang[one]]),
             pa.array([data[b:e].tobytes() for b, e in zip(begin[one], end[one])], pa.binary()),
             pa.array(np.diff(np.append(at, len(order))))], names=["lang", "word", "n"])


def _use_counter(path: str, languages: list[str], p: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        total = np.zeros(p.shape)
        index = {x: i for i, x in enumerate(languages)}
        for batch in batches:
            words = batch.column("word").to_pylist()
            lengths = np.array([len(w) for w in words], np.int64)
            if not len(words):
                continue
            starts = np.concatenate([[0], np.cumsum(lengths)])
            data = np.frombuffer(b"".join(words), np.uint8)
            langs = np.array([index[x] for x in batch.column("lang").to_pylist()])
            n = batch.column("n").to_numpy().astype(float)
            for i, j in slices(starts):
                at = starts[i:j + 1] - starts[i]
                lat = lattice(Prefixes(data[starts[i]:starts[j]]), at[:-1], at[1:], vocab)
                lang = langs[i:j][lat.word]
                np.add.at(total, (lat.piece, lang), expected(lat, p[lat.piece, lang], n[i:j]))
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece), pa.array(lang), pa.array(total[piece, lang])], names=["piece", "lang", "used"])
    return run


def fit(labelled: DataFrame, path: str, train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS) -> Model:
    """Learns from ``labelled`` (text, lang), at most about ``train_docs`` of each language.

    To the driver go only one row a language, and the uses of the vocabulary's pieces.
    """
    spark = labelled.sparkSession
    labelled = labelled.where("lang is not null and text is not null").select("lang", "text")
    counts = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    languages = sorted(counts)
    size = len(vocabulary(path))
    if not languages:
        return Model(path, [], np.empty((size, 0)), np.empty(0))
    sample = labelled.sampleBy("lang", {x: min(1.0, train_docs / n) for x, n in counts.items()}, seed=7)
    words = written(
        sample.mapInArrow(_counted_words, "lang string, word binary, n long")
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))
        .repartition(spark.sparkContext.defaultParallelism, "lang", "word"), "words")
    p = np.full((size, len(languages)), 1.0 / size)
    for _ in range(rounds):
        uses = words.mapInArrow(_use_counter(path, languages, p), "piece long, lang long, used double")
        rows = uses.groupBy("piece", "lang").agg(F.sum("used").alias("used")).toPandas()
        used = np.zeros(p.shape)
        used[rows.piece.to_numpy(np.int64), rows.lang.to_numpy(np.int64)] = rows.used
        common = used.sum(axis=1) + 0.01
        common /= common.sum()
        p = used + SHARED_WEIGHT * common[:, None]
        p /= p.sum(axis=0)
    prior = np.array([counts[x] for x in languages], float)
    return Model(path, languages, p, prior / prior.sum())


def predict(docs: DataFrame, model: Model, out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with each text's language and its probability, in columns named ``out``.

    Columns of ``docs`` with such names are replaced.
    """
    docs = docs.drop(*out)
    names = docs.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            lang, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            if model.languages:
                logs = model.log_scores(texts)
                best = logs.argmax(axis=1)
                top = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                for i, text in enumerate(texts):
                    if text and any(map(str.isalpha, text)):  # ends at the first letter
                        lang[i], score[i] = model.languages[best[i]], float(top[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[*names, *out])
        release()

    return docs.mapInArrow(run, f"{fields}, `{out[0]}` string, `{out[1]}` double")
