"""Words of whole Arrow columns at once: bounds and 64-bit hashes by array operations on their bytes.

Words are runs of bytes other than ASCII white space, A-Z lower-cased.  Nothing here makes a Python
object per word, so a batch costs a few passes over its bytes whatever its vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S = [np.uint64(s) for s in (27, 30, 31, 32)]
_SEED = np.uint64(0x9E3779B97F4A7C15)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Keeps the first k bytes of a little-endian chunk of eight.
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> _S[1])) * _M1
    x = (x ^ (x >> _S[0])) * _M2
    return x ^ (x >> _S[2])


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows run together and where each row begins, with the end behind; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32, count=column.offset + len(column) + 1)[column.offset :].astype(np.int64) if len(column) else np.zeros(1, dtype=np.int64)
    if data is None:
        return np.empty(0, dtype=np.uint8), bounds - bounds[0]
    return np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


#: Bytes of text handled at once, one row at least.
SLICE_BYTES = 4 << 20


def byte_slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose texts make about SLICE_BYTES."""
    for batch in batches:
        _, bounds = column_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + SLICE_BYTES)) - 1)
            yield batch.slice(at, upto - at)
            at = upto


@dataclass
class Words:
    """Words of a batch in order: where each begins and ends, its hash, and how many each row has."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    count: np.ndarray


def chunk_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges; ranges of one length up to eight never collide."""
    size = end - start
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    out = mix(mix(size.astype(np.uint64) + _SEED) ^ (eight[start] & _KEEP[np.minimum(size, 8)]))
    live = np.flatnonzero(size > 8)
    at = 8
    while len(live):
        rest = size[live] - at
        out[live] = mix(out[live] ^ (eight[start[live] + at] & _KEEP[np.minimum(rest, 8)]))
        live, at = live[rest > 8], at + 8
    return out


def words(column: pa.Array) -> Words:
    """All words of the column's texts."""
    data, bounds = column_bytes(column)
    data = _LOWER[data]
    if not len(data):
        none = np.empty(0, dtype=np.int64)
        return Words(none, none, none.astype(np.uint64), np.zeros(len(column), dtype=np.int64))
    inner = ~_SPACE[data]
    full = bounds[:-1] < bounds[1:]
    head, tail = bounds[:-1][full], bounds[1:][full] - 1
    first, last = inner.copy(), inner.copy()
    first[1:] &= ~inner[:-1]
    first[head] = inner[head]
    last[:-1] &= ~inner[1:]
    last[tail] = inner[tail]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(start, end, chunk_hashes(data, start, end), np.diff(np.searchsorted(start, bounds)))
