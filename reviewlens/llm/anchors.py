"""Anchored units: the exact filter in front of both repeated-span operators.

A window is ``length`` consecutive elements (bytes or words) of one document.
Every window picks the leftmost smallest k-gram hash inside it as its anchor,
so equal windows have equal anchors at equal offsets. Consecutive windows
with one anchor form a *unit*. Two windows can be equal only if their units
share the anchor's k-gram, and windows of equal units are equal one by one.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_PLACE_BITS = 26
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. n - 1`` modulo 2^64; the longest array asked for is kept."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(n, base, dtype=np.uint64)
        known[:1] = 1
        known = _powers[base] = np.multiply.accumulate(known)
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


class SpanHash:
    """64-bit polynomial hashes of any spans of one code array."""

    def __init__(self, codes: np.ndarray):
        self.sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(codes * powers(_BASE, len(codes)), out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * powers(_INVERSE, len(self.sums))[start])

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return mixed((self.sums[k:] - self.sums[:n]) * powers(_INVERSE, n))


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value of each run of ``width`` values."""
    n = len(values)
    places = np.arange(n, dtype=np.uint64)
    # a longer array takes more bits for its places and leaves fewer of the values
    bits = max(_PLACE_BITS, n.bit_length())
    keys = (values >> np.uint64(bits) << np.uint64(bits)) | places
    pad = -n % width
    if pad:
        keys = np.concatenate([keys, np.full(pad, np.iinfo(np.uint64).max, dtype=np.uint64)])
    blocks = keys.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(behind[: n - width + 1], ahead[width - 1 : n])
    return (low & np.uint64((1 << bits) - 1)).astype(np.int64)


def units(codes: np.ndarray, bounds: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Units of concatenated documents.

    codes: uint64 code of every element; bounds: document starts, then the end.
    Returns document number, first window start, number of windows (both
    relative to the document), anchor hash and unit hash, one entry per unit.
    """
    empty = tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if len(codes) < length:
        return empty
    spans = SpanHash(codes)
    anchor = leftmost_minima(spans.grams(k), length - k + 1)
    sizes = np.diff(bounds)
    doc = np.repeat(np.arange(len(sizes)), sizes)[: len(anchor)]
    inside = np.arange(len(anchor)) + length <= bounds[1:][doc]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return empty
    anchor, doc = anchor[starts], doc[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(starts)))
    low = starts[head]
    # the anchor's offset is part of a unit: equal text around another anchor place is another unit
    whole = spans(low, low + count + length - 1) ^ mixed((anchor[head] - low).astype(np.uint64))
    return doc[head], low - bounds[:-1][doc[head]], count, spans(anchor[head], anchor[head] + k), whole
