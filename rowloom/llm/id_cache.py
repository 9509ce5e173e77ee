"""Ids of the different words of a text, kept in a bounded cache of a worker."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, repeat

import numpy as np

CACHED = 600_000


class IdCache:
    """Words and their ids in growing arrays; ``learn`` gives the ids of new words.

    A full cache keeps the words that were used again since it was last full.
    """

    def __init__(self, learn: Callable[[list[bytes]], list[list[int]]], limit: int = CACHED):
        self.learn, self.limit = learn, limit
        self._empty()

    def _empty(self) -> None:
        self.index: dict[bytes, int] = {}
        self.flat = np.empty(1 << 16, "<u4")
        self.start, self.size, self.uses = (np.zeros(1 << 14, np.int64) for _ in range(3))
        self.used = 0

    def _room(self, name: str, need: int) -> None:
        have = getattr(self, name)
        if need > len(have):
            setattr(self, name, np.concatenate([have, np.zeros(max(need, 2 * len(have)) - len(have), have.dtype)]))

    def put(self, words: list[bytes], ids: list[list[int]]) -> None:
        n, m = len(self.index), len(words)
        sizes = np.fromiter(map(len, ids), np.int64, m)
        flat = np.fromiter(chain.from_iterable(ids), "<u4", int(sizes.sum()))
        for name in ("start", "size", "uses"):
            self._room(name, n + m)
        self._room("flat", self.used + len(flat))
        self.flat[self.used : self.used + len(flat)] = flat
        self.start[n : n + m] = self.used + np.cumsum(sizes) - sizes
        self.size[n : n + m] = sizes
        self.uses[n : n + m] = 0
        self.used += len(flat)
        self.index.update(zip(words, range(n, n + m)))

    def _trim(self) -> None:
        again = self.uses > 1
        kept = [(w, self.flat[self.start[i] : self.start[i] + self.size[i]].tolist()) for w, i in self.index.items() if again[i]]
        self._empty()
        if len(kept) < self.limit // 2:
            self.put([w for w, _ in kept], [x for _, x in kept])

    def ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and where each word's end."""
        if len(self.index) > self.limit:
            self._trim()
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0).tolist()
        todo = list(dict.fromkeys(words[i] for i in new))
        for k in range(0, len(todo), 10_000):
            self.put(todo[k : k + 10_000], self.learn(todo[k : k + 10_000]))
        at[new] = [self.index[words[i]] for i in new]
        self.uses += np.bincount(at, minlength=len(self.uses)) if len(words) > 10_000 else 0
        if len(words) <= 10_000:
            np.add.at(self.uses, at, 1)
        lengths = self.size[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.start[at] - (ends - lengths), lengths) + np.arange(total)], ends
