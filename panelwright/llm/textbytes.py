"""Vectorised work on the UTF-8 bytes of Arrow string columns, inside tasks.

A batch is cut into pieces of bounded size, and each piece's words are found and hashed with a few numpy passes,
without making Python strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a single longer text is worked on alone.
PIECE_BYTES = 1 << 21

_WHITE = np.zeros(256, bool)
_WHITE[[32, *range(9, 14)]] = True
#: For ``word_bounds``: every ASCII character but letters and digits.
NOT_LETTERS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUE = np.random.default_rng(20240607).integers(0, 1 << 64, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x + np.uint64((salt * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(base: int, n: int) -> np.ndarray:
    """base ** i for i below n, modulo 2 ** 64; kept between calls unless a very long text asked for it."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, PIECE_BYTES + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * PIECE_BYTES:
            _powers[base] = have
    return have[:n]


def pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets) of consecutive pieces; a null text counts as an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type == pa.large_string():
        width = np.int64
    else:
        column, width = column.cast(pa.string()), np.int32
    n = len(column)
    if not n:
        return
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + PIECE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last - first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def cuts(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``PIECE_BYTES`` of one text's bytes, cut at white space; a single longer word is kept whole."""
    first = 0
    while len(data) - first > PIECE_BYTES:
        white = np.flatnonzero(_WHITE[data[first : first + PIECE_BYTES]])
        if len(white):
            last = first + int(white[-1]) + 1
        else:
            last = first + PIECE_BYTES
            while last < len(data) and not _WHITE[data[last]]:
                last += 1
        yield first, last
        first = last
    yield first, len(data)


def word_bounds(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each run of bytes other than ``breaks``, ASCII white space unless given, in order."""
    n = len(data)
    inside = ~breaks[data]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    before[edges] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each span of bytes; with ``lower``, A-Z count as a-z."""
    values = _BYTE_VALUE[_LOWER[data] if lower else data]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values * _power_table(_BASE, len(data)), out=sums[1:])
    inner = (sums[end] - sums[start]) * _power_table(_BASE_INVERSE, len(data) + 1)[start]
    return mix(inner + (end - start).astype(np.uint64))


def code_points(data: np.ndarray) -> np.ndarray:
    """For each byte offset from 0 to len(data): how many characters begin before it."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
