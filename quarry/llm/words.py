"""Vectorised word hashing of whole texts inside a task.

A word is a maximal run of bytes 0-9, a-z, A-Z (lower-cased) or >= 0x80, that
is ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased:
every byte of a non-ASCII UTF-8 character is >= 0x80.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18          # texts are hashed in slices of about this size
_BASE = np.uint64(0x9E3779B97F4A7C15)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[ord("0"):ord("9") + 1] = True
_IS_WORD[ord("a"):ord("z") + 1] = True
_IS_WORD[ord("A"):ord("Z") + 1] = True
_IS_WORD[0x80:] = True

_powers = np.ones(1, dtype=np.uint64)


def _pow(n: int) -> np.ndarray:
    """The first n powers of the base modulo 2^64."""
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 2 * len(_powers), 64), _BASE, dtype=np.uint64)
        grown[0] = 1
        _powers = np.cumprod(grown)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_string(col.type) and not pa.types.is_large_string(col.type):
        col = col.cast(pa.string())
    col = pc.fill_null(col, "").cast(pa.large_string())
    _, offsets, data = col.buffers()
    if offsets is None or len(col) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(col) + 1, dtype=np.int64)
    off = np.frombuffer(offsets, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, off


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes, one text at least."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


class Words:
    """The words of a slice of texts: hash, text number, and byte range."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, i: int, j: int):
        base = offsets[i]
        b = _LOWER[raw[base:offsets[j]]]
        cuts = (offsets[i:j + 1] - base).astype(np.int64)
        is_word = _IS_WORD[b]
        first = is_word.copy()
        first[1:] &= ~is_word[:-1]
        inner = cuts[1:-1]
        inner = inner[inner < len(b)]
        first[inner] |= is_word[inner]
        last = is_word.copy()
        last[:-1] &= ~is_word[1:] | first[1:]
        self.bytes = b
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.n_texts = j - i
        self.text = np.searchsorted(cuts, self.start, side="right") - 1
        self.n_words = np.bincount(self.text, minlength=self.n_texts).astype(np.int64)
        if len(self.start) == 0:
            self.hash = np.zeros(0, dtype=np.uint64)
            return
        widths = self.end - self.start
        pos = np.arange(int(widths.sum()), dtype=np.int64)
        begin = np.cumsum(widths) - widths
        pos -= np.repeat(begin, widths)
        value = (b[is_word].astype(np.uint64) + np.uint64(1)) * _pow(int(widths.max()))[pos]
        self.hash = mix(np.add.reduceat(value, begin))

    def word(self, k: int) -> bytes:
        return self.bytes[self.start[k]:self.end[k]].tobytes()

    def prefix_hash(self, n: int) -> np.ndarray:
        """Hash of the first n bytes of each word (of the whole word if shorter)."""
        if len(self.start) == 0:
            return self.hash
        width = np.minimum(self.end - self.start, n)
        out = np.zeros(len(self.start), dtype=np.uint64)
        powers = _pow(n)
        for k in range(n):
            inside = width > k
            at = np.where(inside, self.start + k, self.start)
            out += np.where(inside, (self.bytes[at].astype(np.uint64) + np.uint64(1)) * powers[k], np.uint64(0))
        return mix(out + np.uint64(n))
