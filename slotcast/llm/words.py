"""Words and word windows of a slice of texts as NumPy arrays, without one object per word.

Words are the runs of bytes other than space and 0x09-0x0D, so they are found on the UTF-8
bytes as Arrow holds them. The hash of a word is a polynomial over random byte values, taken
from running sums, and then mixed; 64 bits stand for equality only until an exact check where
an operator asks for one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACES = (0x20, *range(0x09, 0x0E))
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SPACES)] = False
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_LOWER = np.arange(256)
_LOWER[0x41:0x5B] += 0x20
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every bit of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _grow(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = n + (n >> 3)
        _powers = tuple(
            np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b)]).cumprod(dtype=np.uint64)
            for b in (_BASE, _INVERSE)
        )
    return _powers


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # where each text begins, and the end
    start: np.ndarray  # of each word
    end: np.ndarray
    first: np.ndarray  # index of each text's first word, and the number of words

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.per_text)

    def hashes(self, lower: bool) -> np.ndarray:
        values = _VALUES[_LOWER] if lower else _VALUES
        power, inverse = _grow(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(values[self.data] * power[: len(self.data)], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * inverse[self.start])

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of all windows of ``k`` words inside one text."""
        n = len(hashes)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        text = self.text_of_word()
        at = np.flatnonzero(text[: n - k + 1] == text[k - 1 :])
        joined = np.zeros(len(at), np.uint64)
        for step in range(k):
            joined = mix(joined + hashes[at + step] + np.uint64(step + 1))
        return at, joined


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array, without copying; nulls count as empty."""
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = texts.buffers()
    size = np.dtype(kind).itemsize
    if offsets is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    ends = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * size).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def find_words(texts: pa.Array, is_word: np.ndarray = _IS_WORD) -> Words:
    """Words of each text; ``is_word`` says which bytes belong to one."""
    data, offsets = buffers(texts)
    inside = is_word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))
