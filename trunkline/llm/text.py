"""Whole texts as byte arrays inside tasks: words, word hashes and rolling window hashes.

Arrow hands a batch of texts over as one buffer. Everything here works on that buffer with
numpy, so no Python object is made per word. A batch is cut into pieces of whole texts.
"""

from __future__ import annotations

import contextlib
import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Executors need not have the package: these functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WHITE = tuple(range(9, 14)) + (32,)
#: Bytes of text worked on at once; the arrays for it fit a core's cache.
PIECE_BYTES = 1 << 19
_BYTE_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xC2B2AE3D27D4EB4F | 1


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; null counts as empty."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    if column.null_count:
        lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
        if (lengths != np.diff(offsets)).any():
            return utf8(column.fill_null(b""))
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` bytes of text each; column 1 is the text.

    After a batch the worker gives back what it has freed.
    """
    if not batch.num_rows:
        return
    _, offsets = utf8(batch.column(1))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = max(first + 1, last)
        yield batch.slice(first, last - first)
        first = last
    give_back()


def kept(name: str, make: Callable):
    """A value that the worker makes once and keeps from task to task."""
    values = sys.modules.setdefault("_kept_in_worker", types.ModuleType("kept")).__dict__
    if name not in values:
        values[name] = make()
    return values[name]


def forget(*beginnings: str) -> None:
    """Gives up what the worker keeps under names that begin so; it is made again if needed."""
    values = sys.modules.get("_kept_in_worker")
    for name in [n for n in vars(values) if n.startswith(beginnings)] if values else ():
        del values.__dict__[name]
    give_back()


def give_back() -> None:
    """Returns memory that the worker has freed to the system, for other workers and the JVM."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``size`` powers of an odd base and of its inverse modulo 2**64."""
    tables = kept("powers", dict)
    if base not in tables or len(tables[base][0]) < size:
        length = -(-max(size, 1) // (1 << 19)) << 19
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(length, b, np.uint64)
            steps[0] = 1
            out.append(np.cumprod(steps, dtype=np.uint64))
        tables[base] = (out[0], out[1])
    return tables[base]


def _byte_values() -> np.ndarray:
    def make():
        return np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)

    return kept("byte values", make)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a hash over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xA0761D6478BD642F)


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """Sums from which ``ranged`` takes the hash of any range of ``values``."""
    up, _ = powers(base, len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:], dtype=np.uint64)
    return out


def ranged(sums: np.ndarray, base: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of the values from ``first`` up to, not with, ``last``; equal wherever they stand."""
    _, down = powers(base, len(sums))
    return (sums[last] - sums[first]) * down[first]


def byte_sums(data: np.ndarray) -> np.ndarray:
    return prefix(_byte_values()[data], _BYTE_BASE)


def byte_hash(sums: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mix(ranged(sums, _BYTE_BASE, first, last))


def word_sums(hashes: np.ndarray) -> np.ndarray:
    return prefix(hashes, _WORD_BASE)


def word_hash(sums: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mix(ranged(sums, _WORD_BASE, first, last))


def separators(kind: str) -> np.ndarray:
    """Bytes that are in no word. ``white``: white space; ``alnum``: ASCII but 0-9, a-z."""
    sep = np.zeros(256, bool)
    if kind == "white":
        sep[list(WHITE)] = True
    else:
        sep[0x00:0x30] = sep[0x3A:0x61] = sep[0x7B:0x80] = True
    return sep


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def words(
    data: np.ndarray, offsets: np.ndarray, sep: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word, and each text's range of words."""
    n = len(data)
    inside = np.empty(n + 1, bool)
    np.logical_not(sep[data], out=inside[:n])
    inside[n] = False
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    before = np.empty(n + 1, bool)
    before[0] = False
    before[1:] = inside[:n]
    first = np.flatnonzero(inside & (border | ~before))
    last = np.flatnonzero(before & (border | ~inside))
    return first, last, np.searchsorted(first, offsets)


def hashed_words(
    data: np.ndarray, offsets: np.ndarray, sep: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of every word, and each text's range of words."""
    first, last, of = words(data, offsets, sep)
    return byte_hash(byte_sums(data), first, last), first, last, of


def each_of(ranges: np.ndarray) -> np.ndarray:
    """For every item of consecutive ranges the number of its range."""
    return np.repeat(np.arange(len(ranges) - 1), np.diff(ranges))


def binary(parts: np.ndarray, ranges: np.ndarray) -> pa.Array:
    """Arrow binaries of consecutive ranges of an array of numbers."""
    width = parts.dtype.itemsize
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(),
        len(ranges) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(ranges * width, np.int64)), pa.py_buffer(np.ascontiguousarray(parts))],
    ).cast(pa.binary())
