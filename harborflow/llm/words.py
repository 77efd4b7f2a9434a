"""Vectorised words of whole texts, for tasks that work on Arrow batches.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D (so never splits a UTF-8 character). A chunk of texts is
hashed at once over random byte values, finished per span, so that equal words have equal 64-bit hashes everywhere. Chunks are cut at document ends by size in bytes: memory follows the chunk, or one long text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_U = np.uint64
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand and kept per worker."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))
        return cls.up, cls.down


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, text offsets from 0) of consecutive rows; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if pa.types.is_binary(column.type) else column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_large_string(column.type) else b"")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    begin = 0
    while begin < n:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1)
        low, high = int(offsets[begin]), int(offsets[end])
        yield begin, end, data[low:high], offsets[begin:end + 1] - low
        begin = end


def spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word of every text (one more entry closes the last).

    `between` says of each byte value whether it stands between words.
    """
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = ~between[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | cut[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return start, end, np.searchsorted(start, offsets)


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    up, _ = _Powers.to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span of the data behind `sums` (see prefix_hashes): for keys, not for equality."""
    _, down = _Powers.to(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


class _Weights:
    """A random odd number for every place in a span, grown on demand and kept per worker."""

    values = np.zeros(0, np.uint64)

    @classmethod
    def to(cls, n: int) -> np.ndarray:
        if len(cls.values) < n:
            places = np.arange(max(n, 1 << 16), dtype=np.uint64)
            cls.values = mix(mix(places + _U(0x6A09E667F3BCC909)) + _U(0xBB67AE8584CAA73B)) | _U(1)
        return cls.values


def text_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash that stands for the bytes of each of some spans, which are in order and do not overlap.

    Every byte's random value is weighted by a random number of its place, so unlike sums of powers (`span_hashes`, for keys
    that are verified later) there is no pattern of bytes, of whatever length, that cancels out.
    """
    if not len(start):
        return np.zeros(0, np.uint64)
    n, origin = len(data), int(start[0])
    room = np.append(start[1:], n) - start
    place = np.arange(origin, n) - np.repeat(start, room)
    sums = np.zeros(n - origin + 1, np.uint64)
    np.cumsum(_BYTE[data[origin:]] * _Weights.to(int(room.max()))[place], out=sums[1:])
    return mix(sums[end - origin] - sums[start - origin] + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive entries, in order."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for j in range(1, k):
        out = out * _U(0xD1342543DE82EF95) + words[j:j + n]
    return mix(out)


def runs_inside(first: np.ndarray, k: int) -> np.ndarray:
    """For the runs of run_hashes: whether a run lies inside one text."""
    n = int(first[-1]) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    ok = np.ones(n, bool)
    for stop in np.unique(first[1:-1]):
        ok[max(0, stop - k + 1):min(n, stop)] = False
    return ok
