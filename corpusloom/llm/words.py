"""Words of whole Arrow batches as 64-bit hashes, in numpy, without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .base import by_value

by_value(__name__)

#: Odd multipliers of the hash; any fixed odd constants do.
#: Flags of the bytes that words are made of: all but ASCII white space.
SPACE_ENDS = np.ones(256, bool)
SPACE_ENDS[[0x20, *range(0x09, 0x0E)]] = False
C1, C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=column.offset + n + 1)[column.offset :].copy()
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and n else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def loads(data: np.ndarray) -> np.ndarray:
    """A view with the little-endian 64-bit word that starts at each byte; data ends in 8 spare bytes."""
    return np.ndarray((len(data) - 7,), dtype="<u8", buffer=data.data, strides=(1,))


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and document of each maximal run of bytes for which is_word (256 flags) holds; runs end with their document."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][(offsets[:-1] < n) & (np.diff(offsets) > 0)]
    first[edges] = inside[edges]
    start = np.flatnonzero(first)
    last = inside
    last[:-1] &= ~inside[1:] | first[1:]
    end = np.flatnonzero(last) + 1
    return start, end - start, np.searchsorted(offsets, start, side="right") - 1


def hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte string data[start : start + length]; data ends in 8 spare bytes."""
    at = loads(data)
    out = mixed(length.astype(np.uint64) * C1)
    live, step = np.arange(len(start)), 0
    while len(live):
        left = np.minimum(length[live] - step, 8)
        live, left = live[left > 0], left[left > 0]
        if not len(live):
            break
        word = at[start[live] + step] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - left).astype(np.uint64) * np.uint64(8)))
        out[live] = mixed((out[live] ^ word) * C1 + C2)
        step += 8
    return out
