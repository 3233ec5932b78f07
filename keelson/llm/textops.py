"""Numpy helpers that run inside tasks: words, shingles and their hashes for batches of texts.

Texts arrive as Arrow columns, so that the bytes of a batch are one array. A batch is cut into
runs of whole texts of about ``RUN_BYTES``, which bounds the memory of every array below by a
multiple of the larger of that size and the longest text.
"""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Iterable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 19
SHINGLE_WORDS = 5

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

_random = np.random.Generator(np.random.PCG64(20_260_101))
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _random.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[str, np.ndarray] = {}


Batch = TypeVar("Batch")


def released(batches: Iterable[Batch]) -> Iterator[Batch]:
    """The batches of a task; after the last one its freed memory goes back to the system, since a
    Python worker lives on and counts against the memory of its executor."""
    yield from batches
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(ctypes.util.find_library("c") or None), "malloc_trim", None)
    if trim:  # glibc only
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        out = np.full(max(n, 2 * RUN_BYTES), base, dtype=np.uint64)
        out[0] = 1
        have = np.cumprod(out, dtype=np.uint64)
        if n <= 2 * RUN_BYTES:  # a rare longer text does not keep its table
            _powers[name] = have
    return have[:n]


def text_runs(column: pa.Array | pa.ChunkedArray, run_bytes: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of whole texts: (first row, end row, bytes, offsets).

    A NULL is an empty text here.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string()) if len(column) else column.cast(pa.large_string())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(ends, ends[low] + run_bytes, side="right")) - 1
        high = min(max(high, low + 1), len(column))
        yield low, high, data[ends[low]:ends[high]], ends[low:high + 1] - ends[low]
        low = high


def word_spans(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the index of its first word.

    A word is a run of bytes that are not ``outside`` (by default space, tab, line feed,
    vertical tab, form feed and carriage return); it never crosses two texts.
    """
    inside = ~outside[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edge] = inside[edge]
    stops[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word with A-Z lower-cased."""
    return span_hashes(running_hash(_LOWER[data]), starts, ends)


def running_hash(data: np.ndarray) -> np.ndarray:
    """Sums from which :func:`span_hashes` takes the hash of any span of ``data``."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _power("up", _BASE, len(data)), out=total[1:])
    return total


def span_hashes(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    raw = (total[ends] - total[starts]) * _power("down", _INVERSE, len(total))[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * _PLACE[15])


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct word shingles of each text as sorted 64-bit hashes.

    Returns all sets one after another and the offsets of each. A text with fewer words has
    one shingle, its whole sequence; one without words has none.
    """
    starts, ends, first = word_spans(data, offsets)
    w = word_hashes(data, starts, ends)
    n = np.diff(first)
    width = max(0, len(w) - words + 1)
    rolled = np.zeros(width, dtype=np.uint64)
    for j in range(words):
        rolled += w[j:j + width] * _PLACE[j]
    rolled = mix(rolled)
    sets = []
    for i, count in enumerate(n):
        if count >= words:
            s = np.sort(rolled[first[i]:first[i + 1] - words + 1])
            sets.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif count:
            part = w[first[i]:first[i + 1]]
            sets.append(mix((part * _PLACE[:count]).sum(keepdims=True) + np.uint64(count) * _PLACE[14]))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return np.concatenate(sets), np.concatenate(([0], np.cumsum([len(s) for s in sets])))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def list_column(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))
