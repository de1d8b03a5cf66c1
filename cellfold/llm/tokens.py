"""Words of many texts at once, as numpy arrays over UTF-8 bytes.

Helpers for tasks that read Arrow batches: texts are handled in chunks of
about ``CHUNK`` bytes, so memory stays near 60 bytes per byte of a chunk (or of
the longest single text) however large a batch is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUE = np.random.Generator(np.random.PCG64(20_077)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 ... base ** (n - 1)`` modulo 2^64; kept up to two chunks."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, 2 * CHUNK), base, dtype=np.uint64)
        held[0] = 1
        np.cumprod(held, out=held)
        if n <= 2 * CHUNK:
            _powers[base] = held
    return held[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Well spread 64-bit hashes of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def chunks(column: pa.Array):
    """``(first row, bytes, bounds)`` per chunk of texts; null is empty.
    ``bounds`` has one entry more than rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + CHUNK, side="right")) - 1)
        last = min(last, n)
        yield first, raw[ends[first]:ends[last]], ends[first:last + 1] - ends[first]
        first = last


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; runs stop at text bounds."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, dtype=bool)
    cut[bounds] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends


def words(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return runs(~_SPACE[raw], bounds)


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every slice, equal for equal bytes in any chunk."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_VALUE[raw] * powers(_BASE, len(raw)), out=total[1:])
    return mixed((total[ends] - total[starts]) * powers(_INVERSE, len(raw) + 1)[starts])


def distinct_per_text(text: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values per text and the largest number of times one occurs."""
    if not len(value):
        return np.zeros(n), np.zeros(n)
    # text number (below 2^20 in a chunk) and 44 bits of the hash in one sortable number
    key = np.sort((text.astype(np.uint64) << np.uint64(44)) | (value >> np.uint64(20)))
    t = (key >> np.uint64(44)).astype(np.int64)
    new = np.empty(len(t), dtype=bool)
    new[0] = True
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(t)))
    most = np.zeros(n)
    np.maximum.at(most, t[at], times)
    return np.bincount(t[at], minlength=n).astype(float), most
