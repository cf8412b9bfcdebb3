"""Vectorised text helpers shared by the operators of this subpackage.

Everything here works on a slice of a text column laid out as Arrow does it: one
byte buffer plus row offsets. Null texts are empty texts. A word is a maximal run of
bytes other than 0x20 and 0x09-0x0D. Hashes are 64 bits wide; words, lines and byte
windows are hashed from one prefix sum, so the cost is a few array passes per byte.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 17  # a slice and its array passes stay in a core's cache

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20241).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15 | 5
_INV_P = pow(_P, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def _power(base: int, n: int) -> np.ndarray:
    """base ** (0 .. n-1) modulo 2**64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES + 64), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def release() -> None:
    """Give back what a task has left in its worker: power tables that a long text made, the
    free blocks of Arrow's pool, and of the C heap where it is glibc's."""
    for base in [b for b, table in _powers.items() if len(table) > SLICE_BYTES + 64]:
        del _powers[base]
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection), so that every bit depends on every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)
    offs = offs[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0]: offs[-1]], offs - offs[0]


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES,
           rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of at most ``rows`` rows and about ``size`` bytes of text (one
    long text stands alone), which bounds the memory of the array passes."""
    if batch.num_rows == 0:
        return
    col = batch.column(column)
    if col.null_count:
        col = pc.fill_null(col, "")
    ends = np.cumsum(np.asarray(pc.binary_length(col), dtype=np.int64))
    at = 0
    while at < len(ends):
        base = ends[at - 1] if at else 0
        to = min(at + rows, max(at + 1, int(np.searchsorted(ends, base + size, "right"))))
        yield batch.slice(at, to - at)
        at = to


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words per row): a row boundary always ends a word."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs) - 1, np.int64)
    space = _SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = space[:-1]
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = space[1:]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offs))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` reads the hash of any span."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(_P, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes [start, end) of each span, whatever its place."""
    inv = _power(_INV_P, len(prefix))
    lengths = (ends - starts).astype(np.uint64)
    return mix((prefix[ends] - prefix[starts]) * inv[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))


def row_of(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)


def row_sums(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of a byte mask over each row."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


_STEP = [np.uint64(x | 1) for x in np.random.default_rng(77).integers(1, 1 << 63, 16, dtype=np.uint64).tolist()]


def gram_hash(word_hash: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each place ``first``."""
    h = np.full(len(first), length, np.uint64)
    for k in range(length):
        h += mix(word_hash[first + k] ^ _STEP[k]) * _STEP[k + 8 if k < 8 else k - 8]
    return mix(h)
