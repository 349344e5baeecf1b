"""Word hashing over whole Arrow text columns, vectorised with numpy.

Every text operator of this subpackage that needs words on the Python side goes
through :func:`word_batches`.  A batch of texts is one UTF-8 byte buffer; a word
is a maximal run of "word bytes" inside one text, and its 64-bit hash is a
polynomial over the (A-Z lower-cased) bytes, finished with an avalanche mix.
Nothing loops over words in Python.

Nulls count as empty texts.  A text is never cut: batches split between texts
only, so one very long text simply makes one large batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
CHUNK_BYTES = 1 << 18

#: Byte values that end a word when words are separated by white space only.
WHITESPACE = bytes([0x20, *range(0x09, 0x0E)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_table(separators: bytes) -> np.ndarray:
    """Lookup table of 256 booleans: True where the byte belongs to a word."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


SPACED = word_table(WHITESPACE)
#: Words of ASCII letters, digits and everything beyond ASCII, after lower-casing.
ALPHANUMERIC = word_table(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _trimmer():
    """glibc's call that gives freed memory back, or nothing elsewhere: idle workers would keep it."""
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return lambda _: 0


_trim = _trimmer()
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(CHUNK_BYTES * 2, 1 << max(0, n).bit_length())
    if size not in _tables:
        if size > CHUNK_BYTES * 2:  # a very long text: do not keep its tables
            return _powers(_BASE, size), _powers(_INVERSE, size)
        _tables[size] = _powers(_BASE, size), _powers(_INVERSE, size)
    return _tables[size]


class Words(NamedTuple):
    """Words of consecutive texts. ``first[i]:first[i + 1]`` are the words of text ``low + i``."""

    low: int
    data: np.ndarray  # bytes of the batch, lower-cased
    origin: np.ndarray  # where each text begins in data, and the end of the last
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def hash_words(data: np.ndarray, origin: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of a buffer of texts that begin at ``origin``."""
    n = len(data)
    inside = table[data]
    edge = np.empty(n + 1, dtype=bool)
    edge[0] = True
    edge[n] = True
    edge[1:n] = inside[1:] != inside[:-1]
    edge[origin] = True
    cuts = np.flatnonzero(edge)
    begins = cuts[:-1]
    real = inside[begins]
    start, end = begins[real], cuts[1:][real]
    power, inverse = _power_tables(n)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=prefix[1:])
    code = (prefix[end] - prefix[start]) * inverse[start]
    return start, end, mix(code + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_batches(column: pa.Array, table: np.ndarray, chunk: int = CHUNK_BYTES) -> Iterator[Words]:
    """Words of all texts of a column, about ``chunk`` bytes of whole texts at a time."""
    data, offsets = texts_of(column)
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + chunk, side="right")) - 1)
        own = LOWER[data[offsets[low] : offsets[high]]]
        origin = offsets[low : high + 1] - offsets[low]
        if len(own):
            start, end, code = hash_words(own, origin, table)
        else:
            start = end = np.zeros(0, np.int64)
            code = np.zeros(0, np.uint64)
        yield Words(low, own, origin, start, end, code, np.searchsorted(start, origin))
        low = high
    _trim(0)
