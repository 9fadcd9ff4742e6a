"""Words and shingles as 64-bit hashes, computed with numpy on Arrow batches.

A word is a maximal run of bytes other than space and 0x09-0x0D; A-Z count as a-z.
Hashes of all substrings come from one running sum per slice: with an odd multiplier P,
``(sum[j] - sum[i]) / P**i`` is the hash of bytes i..j-1 and 1 / P exists modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

P = 0x9E3779B97F4A7C15
P_INVERSE = pow(P, -1, 1 << 64)
SHINGLE_WORDS = 5
SLICE_BYTES = 2 << 20
SMALL_SLICE = 512 << 10  # where numbers per byte or shingle are several times as large as the text

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection that spreads every input bit (two rounds of xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64))
WORD_CODE = BYTE_CODE[_LOWER]


class Powers:
    """Powers of P and of its inverse, grown to the longest slice seen."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(1 << n.bit_length(), SMALL_SLICE)
            for name, base in (("up", P), ("down", P_INVERSE)):
                steps = np.full(size, np.uint64(base))
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))
        return cls.up[:n], cls.down[:n]


def running(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums (one longer than ``codes``) and the inverse powers to read them with."""
    up, down = Powers.of(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[:-1], out=sums[1:])
    return sums, down


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Parts of a string column of about ``limit`` bytes: first row, last row + 1, bytes, row offsets.

    Nulls count as empty texts. A longer text is a part of its own.
    """
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    column = pc.fill_null(column, "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; words never cross rows."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | cut[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a slice, and the first word of every row (one more entry than rows)."""
    starts, ends = word_bounds(data, offsets)
    sums, down = running(WORD_CODE[data])
    return mix((sums[ends] - sums[starts]) * down[starts]), np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its word shingles.

    A row with fewer words has its whole sequence as one shingle; one without words, none.
    """
    words, first = word_hashes(data, offsets)
    n = max(0, len(words) - size + 1)
    grams = np.zeros(n, np.uint64)
    for j in range(size):
        grams *= np.uint64(P)
        grams += words[j : j + n]
    grams = mix(grams)
    spans = [(a, b - size + 1) if b - a >= size else (a, a) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    for a, b in spans:
        grams[a:b].sort()
    new = np.ones(n, bool)
    new[1:] = grams[1:] != grams[:-1]
    new[[a for a, b in spans if b > a]] = True
    sets = []
    for a, b, (i, j) in zip(first[:-1].tolist(), first[1:].tolist(), spans, strict=True):
        if j > i:
            sets.append(grams[i:j][new[i:j]])
        elif b > a:
            whole = b - a
            for h in words[a:b].tolist():
                whole = (whole * P + h) % (1 << 64)
            sets.append(mix(np.array([whole], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
