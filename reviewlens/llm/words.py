"""Vectorised words and shingles of many texts at once."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from hashlib import blake2b

import numpy as np

from reviewlens.llm.anchors import SpanHash, mixed

#: Words whose bytes are digested at once.
DIGESTED = 500_000
#: Code of each byte value; any fixed, well-spread table does.
BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    """Words of concatenated texts.

    buffer: all bytes, one space after each text; start, end: place of each
    word in it; bounds: first word of each text, then the number of words;
    codes, proofs: the two halves of a 128-bit digest of each word's bytes.
    """

    buffer: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    @cached_property
    def _digests(self) -> np.ndarray:
        parts = [np.zeros((0, 2), dtype=np.uint64)]
        for low in range(0, len(self.start), DIGESTED):
            high = min(low + DIGESTED, len(self.start))
            words = self.buffer[self.start[low] : self.end[high - 1]].tobytes().split()
            place = {word: i for i, word in enumerate(dict.fromkeys(words))}
            digests = b"".join([blake2b(word, digest_size=16).digest() for word in place])
            parts.append(np.frombuffer(digests, dtype=np.uint64).reshape(-1, 2)[np.fromiter(map(place.__getitem__, words), np.int64, len(words))])
        return np.concatenate(parts)

    @property
    def codes(self) -> np.ndarray:
        return self._digests[:, 0]

    @property
    def proofs(self) -> np.ndarray:
        return self._digests[:, 1]

    def sequence_digests(self) -> np.ndarray:
        """128-bit digest of each text's sequence of words, as two numbers."""
        ends = self.bounds.tolist()
        joined = (b" ".join(self.buffer[self.start[a] : self.end[b - 1]].tobytes().split()) if b > a else b"" for a, b in zip(ends, ends[1:]))
        return np.frombuffer(b"".join([blake2b(text, digest_size=16).digest() for text in joined]), dtype=np.int64).reshape(-1, 2)


def words_of(texts: list[bytes], lower: bool = False) -> Words:
    """Words are runs of bytes other than ``[\\x20\\x09-\\x0D]``; ``lower`` folds A-Z."""
    buffer = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    if lower:
        buffer = _LOWER[buffer]
    inside = np.zeros(len(buffer) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[buffer]
    step = np.diff(inside)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    text_starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return Words(buffer, start, end, np.searchsorted(start, text_starts))


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``size``-word shingles; a shorter text is one shingle, none has none."""
    spans = SpanHash(words.codes)
    grams = spans.grams(size) if len(words.codes) >= size else np.zeros(0, dtype=np.uint64)
    sets = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if b - a >= size:
            sets.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            sets.append(spans(np.array([a]), np.array([b])))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets
