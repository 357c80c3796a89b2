"""Vectorised word tables over Arrow string columns (used in Arrow UDFs).

A *word* is a maximal run of digits, ASCII letters and non-ASCII characters;
A-Z count as a-z. Everything works on the UTF-8 bytes of a whole batch, so that
positions map one to one to the original text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Byte to byte: lower-case letters, digits and bytes of non-ASCII characters stay, the rest is 0.
FOLD = np.zeros(256, np.uint8)
FOLD[48:58] = np.arange(48, 58)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_CHUNK_BYTES = 1 << 20
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2**64."""
    have = _powers.get("up")
    if have is None or len(have) <= n:
        size = max(n + 1, _CHUNK_BYTES // 4)
        for name, base in (("up", int(_BASE)), ("down", pow(int(_BASE), -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def _trim() -> Callable[[], object]:
    """A function that gives freed memory back to the system, as far as there is one."""
    try:
        trim = ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return pa.default_memory_pool().release_unused
    return lambda: (pa.default_memory_pool().release_unused(), trim(0))


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """An Arrow UDF that keeps no freed memory from one batch to the next: Python workers live on from stage to stage."""

    @wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        trim = _trim()
        for batch in run(batches):
            yield batch
            trim()
        trim()

    return wrapped


_model: dict[object, object] = {}


def one_model(key: object, make: Callable[[], object]) -> object:
    """The model of a key. A process keeps the latest only: workers go from operator to operator, and models may be large."""
    if key not in _model:
        _model.clear()
        _trim()()
        _model[key] = make()
    return _model[key]


class Words(NamedTuple):
    """Words of several texts: word w is bytes start[w]:end[w]; text t has words first[t]:first[t+1]."""

    data: np.ndarray
    text_at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's folded bytes."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        up, down = _power(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of the texts whose bytes are data[offsets[i]:offsets[i+1]]."""
    folded = FOLD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    word = folded != 0
    before = np.empty_like(word)
    if len(word):
        before[0] = False
        before[1:] = word[:-1]
    start = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty_like(word)
    if len(word):
        after[-1] = False
        after[:-1] = word[1:]
    end = np.flatnonzero(word & (~after | edge[1:])) + 1
    return Words(folded, offsets, start, end, np.searchsorted(start, offsets))


def chunks(column: pa.Array, most_bytes: int = _CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``most_bytes``: (from, to, bytes, offsets).

    A single longer text is a run of its own, whole.
    """
    data, offsets = string_parts(column)
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most_bytes, "right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b
