"""Rows of unequal length as flat numpy arrays, and a bounded memory of what words encode to."""

from __future__ import annotations

from collections.abc import Callable
from itertools import compress, repeat

import numpy as np

MOST_WORDS = 600_000
MOST_IDS = 4_000_000


def offsets(sizes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def gather(flat: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of ``rows`` one after the other (row r holds flat[at[r]:at[r+1]]), and their offsets."""
    sizes = at[rows + 1] - at[rows]
    out = offsets(sizes)
    return flat[np.repeat(at[rows] - out[:-1], sizes) + np.arange(out[-1])], out


class WordMemory:
    """What each word encodes to, worked out once for many words together.  It forgets
    everything when it is full, so a task's memory is bounded whatever the vocabulary."""

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]], dtype: type = np.uint32):
        self.encode, self.dtype = encode, dtype
        self.clear()

    def clear(self) -> None:
        self.row: dict[str | bytes, int] = {}
        self.flat = np.zeros(1 << 16, self.dtype)
        self.at = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _add(self, words: list[str] | list[bytes]) -> None:
        ids, sizes = self.encode(words)
        first, more = len(self.row), len(ids)
        while len(self.flat) < self.used + more:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.at) < first + len(words) + 1:
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.flat[self.used : self.used + more] = ids
        self.at[first : first + len(words) + 1] = self.used + offsets(sizes)
        self.used += more
        self.row.update(zip(words, range(first, first + len(words)), strict=True))

    def _make_room(self) -> None:
        if len(self.row) > MOST_WORDS or self.used > MOST_IDS:
            self.clear()

    def lookup(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after the other, and the offsets of the words."""
        self._make_room()
        if new := [w for w in set(words) if w not in self.row]:
            self._add(new)
        return gather(self.flat, self.at, np.fromiter(map(self.row.__getitem__, words), np.int64, len(words)))

    def lookup_distinct(self, words: list[bytes], order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for ``words[k]`` with k from ``order``, where no word is twice in ``words``: each is looked for once."""
        self._make_room()
        known = len(self.row)
        rows = np.fromiter(map(self.row.get, words, repeat(-1)), np.int64, len(words))
        new = rows < 0
        if new.any():
            self._add(list(compress(words, new)))
            rows[new] = np.arange(known, len(self.row))
        return gather(self.flat, self.at, rows[order])
