"""Word hashes of Arrow text columns with numpy, for operators that work in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
WHITE = bytes([0x20, *range(0x09, 0x0E)])

_rng = np.random.Generator(np.random.PCG64(20240501))
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWERED_BYTE = _BYTE[_LOWER]
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(WHITE)] = False
_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, for at least n places."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, np.uint64(base))
                steps[0] = 1
                _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def prefix_hashes(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Running polynomial sums of the bytes, one longer than the data; ``span_hash`` reads them."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((_LOWERED_BYTE if lower else _BYTE)[data] * up[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end); equal bytes give equal hashes wherever they are."""
    _, down = powers(len(sums))
    with np.errstate(over="ignore"):
        return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 places where its texts begin; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data, offsets - (offsets[0] if len(offsets) else 0)


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole texts of a column in pieces of about ``size`` bytes: ``first, last, data, offsets``.

    Memory is bounded by the piece, or by the longest single text.
    """
    data, offsets = texts(column)
    first, count = 0, len(column)
    while first < count:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of the texts, A-Z as a-z, and the number of words of each text.

    Words are runs of bytes that are not white space; a word never crosses texts.
    """
    inside = _IS_WORD[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets[:-1]] = True
    begins = begins[: len(data)]
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1] | begins[1:]
    start = np.flatnonzero(fresh)
    stop = np.zeros(len(data) + 1, bool)
    stop[1:] = inside
    stop[1:-1] &= ~inside[1:] | begins[1:]
    end = np.flatnonzero(stop)
    count = np.diff(np.searchsorted(start, offsets))
    return span_hash(prefix_hashes(data, lower=True), start, end), count
