"""Lower-cased terms of texts as Arrow strings, a bounded piece of text at a time.

A term is a maximal run of ASCII letters, digits and characters above U+007F; only A-Z are lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from footfall.llm.words import SLICE_BYTES, slices

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _cuts(data: np.ndarray, limit: int) -> list[int]:
    """Places of about ``limit`` bytes where a long text can be cut: before a byte outside terms."""
    cuts = [0]
    while len(data) - cuts[-1] > limit:
        at = cuts[-1] + limit
        while at < len(data):
            gap = np.flatnonzero(~_INSIDE[data[at : at + limit]])
            if len(gap):
                at += int(gap[0])
                break
            at = min(len(data), at + limit)  # one term longer than the limit stays whole
        cuts.append(at)
    return [*cuts, len(data)] if cuts[-1] < len(data) else cuts


def term_pieces(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """(row of each term, the terms) of a text column; a long text comes in several pieces. Nulls have no terms."""
    for first, last, data, offsets in slices(column, limit):
        cuts = _cuts(data, limit) if last == first + 1 else [0, len(data)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = data[a:b]
            inside = _INSIDE[part]
            edge = np.zeros(len(part) + 1, bool)
            edge[np.clip(offsets - a, 0, len(part))] = True
            start = inside.copy()
            start[1:] &= ~inside[:-1] | edge[1:-1]
            starts = np.flatnonzero(start)
            if not len(starts):
                continue
            kept = _LOWER[part[inside]]
            place = np.flatnonzero(start[inside]).astype(np.int32)
            ends = np.append(place, np.int32(len(kept)))
            terms = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends.tobytes()), pa.py_buffer(kept.tobytes()))
            yield first + np.searchsorted(offsets, a + starts, "right") - 1, terms
