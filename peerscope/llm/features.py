"""Hashed word and character n-gram features of many texts at once, as numpy arrays.

Texts are joined with spaces into one byte buffer; an n-gram is ``n`` consecutive bytes of which only the first
and the last may be a space, so it may hold a word boundary but not parts of two words.  A gram of at most 8
bytes is one unaligned 64-bit load, a multiplication and a shift.
"""

from __future__ import annotations

import numpy as np

from peerscope.llm.common import mix64

_K = np.uint64(0x9E3779B97F4A7C15)
_POWERS = mix64(np.arange(4096, dtype=np.uint64) + np.uint64(7)) | np.uint64(1)

#: white space becomes a space, all else stays
KEEP_ALL = bytes(0x20 if b in b"\t\n\r\x0b\x0c" else b for b in range(256))
#: lower case; signs and digits become a space
LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else (b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20) for b in range(256))


class Hashed:
    def __init__(self, texts: list[bytes], table: bytes, bits: int):
        self.bits, self.n_texts = bits, len(texts)
        self.buf = np.frombuffer(b" " + b" ".join(texts).translate(table) + b" " * 9, dtype=np.uint8)
        lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.bounds = np.append(np.cumsum(lens + 1) - lens - 1, (lens + 1).sum())     # of each text with the space before it
        self.space = self.buf == 0x20
        self._cum = np.cumsum(self.space, dtype=np.int32)
        self._words()

    def _words(self) -> None:
        edge = np.flatnonzero(self.space[1:] != self.space[:-1]) + 1
        self.starts, self.ends = edge[0::2], edge[1::2]
        if self.starts.size:
            begin = np.zeros(self.buf.size, dtype=np.int32)
            begin[self.starts] = self.starts
            place = np.arange(self.buf.size, dtype=np.int32) - np.maximum.accumulate(begin)
            value = (self.buf + np.uint64(1)) * _POWERS[place & 4095]
            value[self.space] = 0
            self.word_hash = mix64(np.add.reduceat(value, self.starts))
        else:
            self.word_hash = np.zeros(0, dtype=np.uint64)

    def owners(self, at: np.ndarray) -> np.ndarray:
        """Number of the text that holds each (sorted or unsorted) position."""
        return np.searchsorted(self.bounds, at, side="right") - 1

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, buckets) of the n-grams."""
        size = self.buf.size - 8
        inside = self._cum[n - 2:size + n - 2] == self._cum[:size]
        if n == 3:
            inside &= ~(self.space[:size] & self.space[2:size + 2])
        at = np.flatnonzero(inside)
        at = at[at < self.bounds[-1]]
        words = np.ndarray((size,), dtype="<u8", buffer=self.buf.data, strides=(1,))[at]
        words &= np.uint64((1 << 8 * n) - 1)
        words *= _K + np.uint64(2 * n)
        words ^= words >> np.uint64(29)
        words *= _K
        return at, (words >> np.uint64(64 - self.bits)).astype(np.int32)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """(positions, buckets) of the words."""
        return self.starts, (self.word_hash >> np.uint64(64 - self.bits)).astype(np.int32)

    def repeats(self) -> np.ndarray:
        """Positions of words that equal the word before them in the same text."""
        same = np.flatnonzero(self.word_hash[1:] == self.word_hash[:-1]) + 1
        at = self.starts[same]
        return at[self.owners(at) == self.owners(self.starts[same - 1])]

    def sums(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Sum of the values by text; ``at`` must be sorted."""
        total = np.append(0.0, np.cumsum(values, dtype=np.float64))
        cut = np.searchsorted(at, self.bounds)
        return total[cut[1:]] - total[cut[:-1]]

    def counts(self, at: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(at, self.bounds))
