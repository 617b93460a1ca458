"""Token pieces of documents packed into sequences by best-fit decreasing.

A document is cut into full windows from its start; what is left over is one shorter piece.
Pieces are spread over bundles by a hash of their place in the stored table, so that neither
equal nor missing ids gather in one task; in a bundle
the pieces go, longest first, into the open sequence with the least room that still
suffices, found by a segment tree over the remaining capacities.

A null or empty text holds the end token alone. Repeated rows are packed each for itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmart.llm.common import release, remembered, written

CAPACITY = 4096
#: Pieces that one task packs together.
BUNDLE = 50_000
#: Words whose ids a worker remembers.
WORDS = 1_500_000

#: Separators that not every library counts as white space. Texts with them are encoded whole.
DOUBTFUL = "\x1c\x1d\x1e\x1f"
#: A character that is one token of its own.
MARK = "\x01"


@cache
def tokenizer(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _lower(text: str) -> str:
    """Lower case where all rules agree on it: if there are only Latin-1 characters."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


class WordIds:
    """Ids of texts, by words between white space that were encoded before.

    The vocabulary drops white space and no token spans it, so a text's ids are its words'. Texts
    that hold an added token as it is written, in any case, go whole: it is matched before the rest.
    """

    def __init__(self, path: str, most: int = WORDS):
        self.tokenizer, self.most = tokenizer(path), most
        self.known: dict[str, bytes] = {}
        self.added = [_lower(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        (self.mark,) = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.signs = dict(zip(".,", self._whole([".", ","])))

    def _whole(self, texts: list[str]) -> list[bytes]:
        """Ids from the library; many texts go as one, with a mark between that none has."""
        marked = [i for i, t in enumerate(texts) if MARK in t]
        parts = [[t for t in texts[at:at + 1000] if MARK not in t] for at in range(0, len(texts), 1000)]
        rows = self.tokenizer.encode_batch_fast(
            [f" {MARK} ".join([*p, ""]) for p in parts] + [texts[i] for i in marked], add_special_tokens=False)
        alone = {i: np.array(e.ids, "<u4").tobytes() for i, e in zip(marked, rows[len(parts):])}
        out = []
        for part, found in zip(parts, rows):
            ids = np.array(found.ids, "<u4")
            ends = np.flatnonzero(ids == self.mark).tolist()
            data = ids.tobytes()
            out += [data[4 * s:4 * e] for s, e in zip([0, *(e + 1 for e in ends)], ends)]
        if alone:
            plain = iter(out)
            out = [alone[i] if i in alone else next(plain) for i in range(len(texts))]
        return out

    def _learn(self, words: set[str]) -> None:
        """Remembers new words; of one in Latin letters a last point or comma is taken off."""
        ends = {}
        for word in words:
            if word[-1:] in self.signs:
                stem = word[:-1]
                if stem.isalpha() and (stem.isascii() or max(stem) <= "ÿ"):
                    ends[word] = stem
        new = list(words.difference(ends).union(ends.values()).difference(self.known))
        self.known.update(zip(new, self._whole(new)))
        self.known.update((word, self.known[stem] + self.signs[word[-1]]) for word, stem in ends.items())

    def _split(self, text: str) -> list[str]:
        if any(c in text for c in DOUBTFUL):
            return [text]
        lower = _lower(text)
        return [text] if any(a in lower or a in text for a in self.added) else lower.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        words = [self._split(t) for t in texts]
        new = set().union(*words).difference(self.known)
        if len(self.known) + len(new) > self.most:
            self.known.clear()
            new = set().union(*words)
        self._learn(new)
        return [b"".join(map(self.known.__getitem__, w)) for w in words]


def word_ids(path: str, most: int) -> WordIds:
    return remembered(("word ids", path, most), lambda: WordIds(path, most))


def pieces(docs: DataFrame, path: str, end_id: int = 2, capacity: int = CAPACITY, words: int = WORDS) -> DataFrame:
    """doc_id, start, length, doc_tokens and ids (binary) of every piece of every document.

    ``words`` is how many words' ids a worker remembers; it trades memory for time only.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    ending = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(path, words).encode
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for at in range(0, len(texts), 200):
                rows = []
                for i, ids in enumerate(encode(texts[at:at + 200]), at):
                    ids += ending
                    n = len(ids) // 4
                    rows += [(i, s, min(capacity, n - s), n, ids[4 * s:4 * (s + capacity)])
                             for s in range(0, n, capacity)]
                which, start, length, total, ids = map(list, zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(which))]
                    + [pa.array(x, pa.int64()) for x in (start, length, total)]
                    + [pa.array(ids, pa.binary())],
                    names=["doc_id", "start", "length", "doc_tokens", "ids"])
        release()

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, start long, length long, doc_tokens long, ids binary")


class OpenSequences:
    """Open sequences by what room they have left; finds the least room that suffices."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(self.size)]

    def put(self, sequence: int, room: int) -> None:
        self.open[room].append(sequence)
        at = room + self.size
        while at and not self.tree[at]:
            self.tree[at] = 1
            at //= 2

    def take(self, need: int) -> tuple[int, int] | None:
        """A sequence with the least room of ``need`` or more, and that room."""
        tree, at = self.tree, need + self.size
        if not tree[at]:
            while at > 1 and (at & 1 or not tree[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if tree[2 * at] else 2 * at + 1
        room = at - self.size
        sequence = self.open[room].pop()
        if not self.open[room]:
            while at and not (at < self.size and (tree[2 * at] or tree[2 * at + 1])):
                tree[at] = 0
                at //= 2
        return sequence, room


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, longest first into the tightest room."""
    spaces, used = OpenSequences(capacity), 0
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        found = spaces.take(n) if n < capacity else None
        if found is None:
            found, used = (used, capacity), used + 1
        sequence[i], offset[i] = found[0], capacity - found[1]
        if found[1] > n:
            spaces.put(found[0], found[1] - n)
    return sequence, offset


def pack(found: DataFrame, capacity: int = CAPACITY, bundle: int = BUNDLE) -> DataFrame:
    """``found`` (with doc_id, start and length) and the place of each piece: sequence_id, offset."""
    names = found.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    found = written(found.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    bundles = max(1, -(-found.count() // bundle))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("__row", "ascending")])
        sequence, offset = best_fit(table.column("length").to_numpy(), capacity)
        first = table.column("__bundle")[0].as_py() << 32
        return table.select(names).append_column("sequence_id", pa.array(sequence + first)) \
            .append_column("offset", pa.array(offset))

    return (
        found.withColumn("__bundle", F.pmod(F.xxhash64("__row"), F.lit(bundles)))
        .groupBy("__bundle").applyInArrow(run, f"{fields}, sequence_id long, offset long"))
