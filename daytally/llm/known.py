"""Token ids of known pieces of text, found by the pieces' 64-bit hashes."""

from __future__ import annotations

import numpy as np


class KnownIds:
    """Hashes, ascending, and the ids of all of them in one array.

    ``most`` bounds the memory: beyond it everything is forgotten and learned anew.
    """

    def __init__(self, kind: str, most: int):
        self._kind, self._most = kind, most
        self.forget()

    def forget(self) -> None:
        self._hashes, self._starts, self._lengths = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32)
        self._ids = np.empty(0, self._kind)

    def __len__(self) -> int:
        return len(self._hashes)

    def make_room(self) -> None:
        if len(self) > self._most:
            self.forget()

    def missing(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self):
            return np.ones(len(hashes), bool)
        at = np.minimum(np.searchsorted(self._hashes, hashes), len(self) - 1)
        return self._hashes[at] != hashes

    def learn(self, hashes: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        """``hashes`` are new and ascending; ``ids`` are those of all of them in turn."""
        at = np.searchsorted(self._hashes, hashes)
        starts = np.cumsum(lengths, dtype=np.int64) - lengths + len(self._ids)
        self._hashes, self._lengths = np.insert(self._hashes, at, hashes), np.insert(self._lengths, at, lengths)
        self._starts, self._ids = np.insert(self._starts, at, starts), np.concatenate([self._ids, ids])

    def ids_of(self, distinct: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces ``distinct[which]`` in turn, and how many come before each."""
        at = np.searchsorted(self._hashes, distinct)[which]
        lengths = self._lengths[at].astype(np.int64)
        before = np.concatenate([[0], np.cumsum(lengths)])
        gather = np.arange(before[-1]) + np.repeat(self._starts[at] - before[:-1], lengths)
        return self._ids[gather], before


class HashedIds:
    """As :class:`KnownIds`, with the places of pieces in a hash table: little moves when more
    is learned, and pieces need not be distinct to be found.

    The table has four slots or more for each of ``most`` pieces; as many as that may be
    learned at a time."""

    def __init__(self, kind: str, most: int):
        self._kind, self._most = kind, most
        self._mask = (4 << (most - 1).bit_length()) - 1
        self.forget()

    def forget(self) -> None:
        self._places = np.full(self._mask + 1, -1, np.int32)
        self._hashes, self._starts = np.zeros(1, np.uint64), np.zeros(2, np.int64)
        self._ids = np.empty(0, self._kind)
        self._n = 0

    def __len__(self) -> int:
        return self._n

    def make_room(self) -> None:
        if len(self) > self._most:
            self.forget()

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The places of pieces, -1 of those that are not known."""
        slots = (hashes & np.uint64(self._mask)).astype(np.int64)
        found = self._places[slots]
        away = np.flatnonzero((found >= 0) & (self._hashes[found] != hashes))
        while len(away):
            slots[away] = slots[away] + 1 & self._mask
            found[away] = there = self._places[slots[away]]
            away = away[(there >= 0) & (self._hashes[there] != hashes[away])]
        return found

    def learn(self, hashes: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The places of pieces that are new and distinct; ``ids`` are those of all of them in turn."""
        first, n, held = self._n, self._n + len(hashes), int(self._starts[self._n])
        if n > (self._mask + 1) // 2:
            raise ValueError("more pieces at a time than the table has room for")
        self._hashes, self._starts = _room(self._hashes, n), _room(self._starts, n + 1)
        self._ids = _room(self._ids, held + len(ids))
        self._hashes[first:n] = hashes
        self._starts[first + 1 : n + 1] = held + np.cumsum(lengths, dtype=np.int64)
        self._ids[held : held + len(ids)] = ids
        self._n = n
        new = np.arange(first, n, dtype=np.int32)
        slots, left = (hashes & np.uint64(self._mask)).astype(np.int64), new
        while len(left):
            free = self._places[slots] < 0
            self._places[slots[free]] = left[free]
            passed = self._places[slots] != left  # the slot was taken, or is now
            slots, left = slots[passed] + 1 & self._mask, left[passed]
        return new

    def ids_of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces at ``places`` in turn, and how many come before each."""
        starts = self._starts[places]
        lengths = self._starts[places + 1] - starts
        before = np.zeros(len(places) + 1, np.int64)
        np.cumsum(lengths, out=before[1:])
        gather = np.repeat(starts - before[:-1], lengths)
        gather += np.arange(before[-1])
        return self._ids[gather], before


def _room(values: np.ndarray, n: int) -> np.ndarray:
    """``values`` with room for ``n``, and half as many again if they had to move."""
    if len(values) >= n:
        return values
    out = np.zeros(n + n // 2, values.dtype)
    out[: len(values)] = values
    return out
