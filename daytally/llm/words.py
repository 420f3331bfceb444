"""Hashes of all words of a column of texts, in NumPy over the column's own bytes.

A word's hash is a polynomial over its bytes, taken from running sums, so the cost is a
few array operations a byte whatever the words are. Long texts go piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _table(separators) -> np.ndarray:
    is_word = np.ones(256, bool)
    is_word[list(separators)] = False
    return is_word


#: Words end at ASCII white space.
BY_SPACE = _table([0x20, *range(0x09, 0x0E)])
#: Words are runs of ASCII letters and digits and of all characters beyond ASCII.
BY_LETTER = _table(b for b in range(128) if not chr(b).isalnum())
LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
LOWER[65:91] += np.uint64(32)
EXACT = np.arange(256, dtype=np.uint64) + np.uint64(1)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n-1 of the base modulo 2^64, and their inverses."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Hashes of segments of ``data``, equal for equal bytes wherever they stand."""
    n, size = len(data), PIECE
    while size < n:
        size *= 2
    powers, inverses = _powers(size)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(letters[data] * powers[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


def _piece(data: np.ndarray, firsts: np.ndarray, is_word: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of ``data``; a text begins at each of ``firsts``."""
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    inside = is_word[data]
    begins = np.empty(n + 1, bool)
    begins[0], begins[n], begins[1:n] = True, True, ~inside[:-1]
    begins[firsts[firsts < n]] = True
    starts = np.flatnonzero(inside & begins[:n])
    ends_at = begins[1:].copy()
    ends_at[:-1] |= ~inside[1:]
    ends = np.flatnonzero(inside & ends_at) + 1
    return segment_hashes(data, starts, ends, letters), starts, ends


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the bounds of each; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole, bounds


def located_words(
    column: pa.Array, is_word: np.ndarray = BY_SPACE, letters: np.ndarray = LOWER, piece: int = PIECE
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Like :func:`hashed_words`, with the words' starts and ends in the column's bytes."""
    data, at = text_bytes(column)
    n, first = len(column), 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + piece, "right")) - 1)
        low, high = int(at[first]), int(at[last])
        if last == first + 1 and high - low > piece:
            parts = []
            while low < high:
                cut = min(low + piece, high)
                while cut < high and is_word[data[cut]]:
                    cut += 1
                hashes, starts, ends = _piece(data[low:cut], np.zeros(1, np.int64), is_word, letters)
                parts.append((hashes, starts + low, ends + low))
                low = cut
            hashes, starts, ends = (np.concatenate(x) for x in zip(*parts))
            bounds = np.array([0, len(hashes)])
        else:
            firsts = at[first : last + 1] - low
            hashes, starts, ends = _piece(data[low:high], firsts[:-1], is_word, letters)
            bounds = np.searchsorted(starts, firsts)
            starts, ends = starts + low, ends + low
        yield first, last, hashes, bounds, starts, ends
        first = last


def hashed_words(
    column: pa.Array, is_word: np.ndarray = BY_SPACE, letters: np.ndarray = LOWER
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Word hashes of a column of texts, in runs of whole texts of about ``PIECE`` bytes.

    Yields (first, last, hashes, bounds): text ``first + i`` has the words
    ``hashes[bounds[i]:bounds[i + 1]]``. Texts beyond ``PIECE`` are cut between words.
    """
    for first, last, hashes, bounds, _, _ in located_words(column, is_word, letters):
        yield first, last, hashes, bounds


def shingles(hashes: np.ndarray, bounds: np.ndarray, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k words in a row within each text, and the new bounds.

    With ``short``, a text of fewer than k words (and one at least) has its whole
    sequence as its only shingle.
    """
    counts = np.diff(bounds)
    n = len(hashes)
    if n >= k:
        total = hashes[: n - k + 1].copy()
        for i in range(1, k):
            total *= _STEP
            total += hashes[i : n - k + 1 + i]
        starts = np.arange(n - k + 1)
        text = np.searchsorted(bounds, starts, "right") - 1
        fits = starts + k <= bounds[text + 1]
        values, owner = mix(total[fits]), text[fits]
    else:
        values, owner = np.empty(0, np.uint64), np.empty(0, np.int64)
    few = np.flatnonzero((counts > 0) & (counts < k)) if short else np.empty(0, np.int64)
    if len(few):
        whole = np.empty(len(few), np.uint64)
        for j, i in enumerate(few):
            value = int(counts[i])
            for h in hashes[bounds[i] : bounds[i + 1]]:
                value = (value * int(_STEP) + int(h)) & (2**64 - 1)
            whole[j] = value
        values, owner = np.concatenate([values, mix(whole)]), np.concatenate([owner, few])
        order = np.argsort(owner, kind="stable")
        values, owner = values[order], owner[order]
    return values, np.searchsorted(owner, np.arange(len(counts) + 1))


def distinct_sorted(values: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The distinct values of each text, ascending."""
    return [np.unique(values[bounds[i] : bounds[i + 1]]) for i in range(len(bounds) - 1)]
