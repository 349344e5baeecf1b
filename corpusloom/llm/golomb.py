"""Golomb-Rice coding of sorted integers, vectorised.

Gaps between neighbours are split by a power of two near their mean: quotients
go to a unary bit stream, remainders to a stream of fixed width.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QIBI")


def encode(values: np.ndarray, base: int, width: int) -> bytes:
    """Code of distinct sorted values within ``[base, base + width)``."""
    k = len(values)
    if not k:
        return b""
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(base))
    r = max(0, int(width // k).bit_length() - 1)
    quotient = (gaps >> np.uint64(r)).astype(np.int64)
    unary = np.zeros(int(quotient.sum()) + k, dtype=np.uint8)
    unary[np.cumsum(quotient + 1) - 1] = 1
    high = np.packbits(unary).tobytes()
    bits = np.unpackbits(gaps.astype(">u8").view(np.uint8).reshape(k, 8), axis=1)[:, 64 - r :]
    return _HEAD.pack(base, k, r, len(high)) + high + np.packbits(bits).tobytes()


def decode(blob: bytes) -> np.ndarray:
    """The values of a code, sorted."""
    if not blob:
        return np.zeros(0, np.uint64)
    base, k, r, size = _HEAD.unpack_from(blob)
    at = _HEAD.size
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, size, at)))[:k]
    gaps = np.diff(ends, prepend=-1).astype(np.uint64) - np.uint64(1)
    if r:
        bits = np.zeros((k, 64), dtype=np.uint8)
        bits[:, 64 - r :] = np.unpackbits(np.frombuffer(blob, np.uint8, offset=at + size))[: k * r].reshape(k, r)
        gaps = (gaps << np.uint64(r)) | np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)
    return np.cumsum(gaps) + np.uint64(base)
