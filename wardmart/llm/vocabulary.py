"""Terms of texts, and minimal acyclic transducers that number them in order.

A term is a run of ASCII letters and of characters beyond ASCII; only A-Z become lower case.
Sorted terms become a transducer: states that the rest of a term cannot tell apart are one
state, and the counts on its edges add up to a term's ordinal among the sorted terms. A large
vocabulary is a row of transducers, each over a bounded stretch of the order.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from os.path import commonprefix

import numpy as np

#: Bytes of a text that are cut into terms at once.
PIECE = 1 << 20

_SPACE = 0x20


def _plain(byte: int) -> int:
    if ord("A") <= byte <= ord("Z"):
        return byte + 32
    return byte if ord("a") <= byte <= ord("z") or byte >= 0x80 else _SPACE


_PLAIN = bytes(map(_plain, range(256)))


def pieces(text: bytes) -> Iterator[bytes]:
    """A whole text in UTF-8 with blanks between its terms, some at a time; no term is cut."""
    data = text.translate(_PLAIN)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole text, some at a time."""
    return (piece.split() for piece in pieces(text))


class Tally:
    """Counts of terms by language and a further key, which a task holds for a while.

    The terms of a language are numbered as they come, and their occurrences are kept as numbers
    until they are counted. ``full`` tells when terms, their bytes or occurrences are many.
    """

    def __init__(self, most: int, most_bytes: int):
        self.most, self.most_bytes = most, most_bytes
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, defaultdict] = {}
        self.found: dict[tuple, list[np.ndarray]] = {}
        self.size = self.bytes = 0

    def numbered(self, lang: str, piece: bytes) -> np.ndarray:
        """The numbers of a piece's terms."""
        numbers = self.numbers.get(lang)
        if numbers is None:
            numbers = self.numbers[lang] = defaultdict()
            numbers.default_factory = numbers.__len__
        before, words = len(numbers), piece.split()
        out = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
        self.size += len(numbers) - before
        self.bytes += len(piece)
        return out

    def add(self, key: tuple, occurrences: np.ndarray) -> None:
        """Occurrences of numbered terms under ``key``, which begins with their language."""
        self.found.setdefault(key, []).append(occurrences)

    @property
    def full(self) -> bool:
        return self.size >= self.most or self.bytes >= self.most_bytes

    def words(self, lang: str) -> list[bytes]:
        """The terms of a language by their numbers."""
        return list(self.numbers.get(lang, ()))

    def counted(self) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
        """Every key with the numbers of its terms and their counts."""
        for key, parts in self.found.items():
            yield key, *np.unique(np.concatenate(parts), return_counts=True)


@dataclass(frozen=True)
class Transducer:
    """Edges sorted by state and byte: their keys, where they lead, and how many words of the
    state come before theirs; whether a word ends in a state; where all words start."""

    keys: np.ndarray
    targets: np.ndarray
    skips: np.ndarray
    final: np.ndarray
    root: int

    @classmethod
    def of(cls, words: Iterable[bytes]) -> Transducer:
        """From words in ascending order of their bytes, each once.

        Only the states along the last word are open; a state is closed when a later word
        leaves it, and joins an equal closed state if there is one.
        """
        closed: dict[tuple, int] = {}
        below: list[int] = []
        path: list[tuple[list, list]] = [([], [])]
        last = b""

        def close() -> int:
            ends, edges = path.pop()
            state = closed.setdefault((bool(ends), tuple(edges)), len(closed))
            if state == len(below):
                below.append(len(ends) + sum(below[target] for _, target in edges))
            return state

        def shorten(length: int) -> None:
            while len(path) > length + 1:
                byte = last[len(path) - 2]
                state = close()
                path[-1][1].append((byte, state))

        for word in words:
            same = len(commonprefix([last, word]))
            shorten(same)
            path.extend(([], []) for _ in range(len(word) - same))
            path[-1][0].append(True)
            last = word
        shorten(0)
        root = close()
        keys, targets, skips, final = [], [], [], []
        for (ends, edges), state in closed.items():
            before = int(ends)
            for byte, target in edges:
                keys.append(state << 8 | byte)
                targets.append(target)
                skips.append(before)
                before += below[target]
            final.append(ends)
        return cls(np.array(keys, np.int64), np.array(targets, np.int32), np.array(skips, np.int32),
                   np.array(final, bool), root)

    def _edges(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of edges and whether they are there."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        return at, self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)

    def ordinals(self, words: list[bytes]) -> np.ndarray:
        """The ordinal of each word, -1 for one that is not held; all words go on byte by byte."""
        data = np.frombuffer(b"".join(words), np.uint8)
        length = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(length) - length
        state, ordinal = np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        on, depth = np.arange(len(words)), 0
        while len(on):
            ending = length[on] == depth
            ended = on[ending]
            ordinal[ended[~self.final[state[ended]]]] = -1
            on = on[~ending]
            at, there = self._edges(state[on] << 8 | data[start[on] + depth])
            ordinal[on[~there]] = -1
            on, at = on[there], at[there]
            state[on] = self.targets[at]
            ordinal[on] += self.skips[at]
            depth += 1
        return ordinal

    def word(self, ordinal: int) -> bytes:
        """The word with an ordinal."""
        out, state = bytearray(), self.root
        while ordinal or not self.final[state]:
            low, high = np.searchsorted(self.keys, [state << 8, state + 1 << 8])
            at = low + int(np.searchsorted(self.skips[low:high], ordinal, "right")) - 1
            out.append(int(self.keys[at]) & 255)
            ordinal -= int(self.skips[at])
            state = int(self.targets[at])
        return bytes(out)
