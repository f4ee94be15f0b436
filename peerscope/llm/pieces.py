"""Pre-tokens of byte-level vocabularies as numpy arrays.

The split pattern (contractions, runs of letters, digits or other signs with one leading space, white
space) only needs the class of each code point, so a whole chunk of texts is cut with a few array
operations.  The classes are read off the ``tokenizers`` library's own pattern engine, because Unicode
versions differ between engines.  Pre-tokens are known by a 64-bit hash; a bounded table maps the hashes
seen before to a number, so that a word is encoded once in a task.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np

from peerscope.llm.common import mix64

LETTER, DIGIT, SPACE, OTHER = 1, 2, 3, 4
SEGMENT_CHARS = 1 << 20
START_BITS = 14
_LONG = 4096
_CUT = re.compile(r"(?<=\S) (?=\S)")
_TABLE: list[np.ndarray] = []


def class_table() -> np.ndarray:
    """Class of every code point (uint8), as the tokenizer library's patterns have it; made once per process."""
    if not _TABLE:
        from tokenizers import Regex, pre_tokenizers
        table = np.full(0x110000, OTHER, dtype=np.uint8)
        marks = [(mark, pre_tokenizers.Split(Regex(pattern), "removed"))
                 for mark, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+"))]
        for low in range(0, 0x110000, 0x8000):      # in blocks, the surrogates left out
            points = np.arange(low, low + 0x8000)
            points = points[(points < 0xD800) | (points >= 0xE000)]
            text = points.astype("<u4").tobytes().decode("utf-32-le")
            for mark, split in marks:
                inside = np.ones(points.size, dtype=bool)
                for _, (a, b) in split.pre_tokenize_str(text):
                    inside[a:b] = False
                table[points[inside]] = mark
        _TABLE.append(table)
    return _TABLE[0]


def segments(text: str) -> list[str]:
    """A very long text in parts that tokenise independently: cut before a space between two words."""
    out, start = [], 0
    while len(text) - start > SEGMENT_CHARS:
        m = _CUT.search(text, start + SEGMENT_CHARS)
        if m is None:
            break
        out.append(text[start:m.start()])
        start = m.start()
    return [*out, text[start:] if start else text]


class Pretokens:
    """The pre-tokens of a list of texts: ``starts`` and ``ends`` in the joined string, ``owner`` (number of
    the text) and ``hashes``."""

    _letters = mix64(np.arange(0x110000, dtype=np.uint64) + np.uint64(1))
    _places = mix64(np.arange(_LONG, dtype=np.uint64) + np.uint64(1 << 40)) | np.uint64(1)

    def __init__(self, texts: list[str], table: np.ndarray):
        lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        sep = np.cumsum(lens + 1) - 1
        self.joined = "\n".join(texts) + "\n\n\n"
        cps = np.frombuffer(self.joined.encode("utf-32-le"), dtype="<u4")
        c = table[cps]
        c[sep] = 0
        c[sep[-1] + 1:] = 0
        start = np.empty(c.size, dtype=bool)
        start[0] = True
        np.not_equal(c[1:], c[:-1], out=start[1:])
        start &= c != 0
        nxt = np.append(c[1:], np.uint8(0))
        tail = (c == SPACE) & (nxt != SPACE) & (nxt != 0)       # last white space before a word
        start |= tail
        start[1:] &= ~(tail & (cps == 32))[:-1]                 # a plain space belongs to the word
        quote = np.flatnonzero((cps == 39) & start)
        if quote.size:
            a, b = cps[quote + 1], cps[quote + 2]
            one = np.isin(a, [ord(x) for x in "stmd"])
            two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
            size = np.where(one, 2, 3)[one | two]
            quote = quote[one | two]
            start[quote + 1] = False
            start[quote + size] |= c[quote + size] == LETTER
        edge = np.flatnonzero(start | (c == 0))
        is_start = start[edge]
        self.starts = edge[is_start]
        self.ends = np.append(edge[1:], c.size)[is_start]
        self.owner = np.searchsorted(sep, self.starts)
        self.n_texts = len(texts)
        self.hashes = self._hashes(cps, c)

    def _hashes(self, cps: np.ndarray, c: np.ndarray) -> np.ndarray:
        if not self.starts.size:
            return np.zeros(0, dtype=np.uint64)
        begin = np.zeros(cps.size, dtype=np.int32)
        begin[self.starts] = self.starts
        place = np.arange(cps.size, dtype=np.int32)
        place -= np.maximum.accumulate(begin)
        value = self._letters[cps]
        value *= self._places[place & (_LONG - 1)]
        value[c == 0] = 0
        h = np.add.reduceat(value, self.starts)
        for k in np.flatnonzero(self.ends - self.starts > _LONG).tolist():     # the multipliers repeat there
            h[k] = int.from_bytes(hashlib.blake2b(self.word(k).encode(), digest_size=8).digest(), "little")
        return np.maximum(h, np.uint64(1))

    def word(self, k: int) -> str:
        return self.joined[self.starts[k]:self.ends[k]]


class WordTable:
    """Hash to number (not negative), open addressing in numpy; full with half as many words as ``2 ** bits``.  The table
    starts with ``START_BITS`` and doubles as words come, so that a task holds what its own words need."""

    def __init__(self, bits: int):
        self.most = 1 << (bits - 1)
        self.bits = min(bits, START_BITS)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.values = np.zeros(1 << self.bits, dtype=np.int32)
        self.size = 0

    def full(self) -> bool:
        return self.size > self.most

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each hash, -1 where there is none."""
        mask = (1 << self.bits) - 1
        at = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        held = self.keys[at]
        out = np.where(held == h, self.values[at], np.int32(-1))
        on = np.flatnonzero((held != h) & (held != 0))
        while on.size:
            at[on] = (at[on] + 1) & mask
            held = self.keys[at[on]]
            hit = held == h[on]
            out[on[hit]] = self.values[at[on[hit]]]
            on = on[~hit & (held != 0)]
        return out

    def add(self, h: np.ndarray, values: np.ndarray) -> None:
        """Distinct hashes that are not in the table."""
        while self.size + h.size > 1 << (self.bits - 1):
            keys, held = self.keys, self.values
            self.bits += 1
            self.clear()
            self.add(keys[keys != 0], held[keys != 0])
        mask = (1 << self.bits) - 1
        at, left = (h >> np.uint64(64 - self.bits)).astype(np.int64), np.arange(h.size)
        while left.size:
            free = left[self.keys[at[left]] == 0]
            slot, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[slot], self.values[slot] = h[won], values[won]
            lost = np.ones(h.size, dtype=bool)
            lost[won] = False
            left = left[lost[left]]
            at[left] = (at[left] + 1) & mask
        self.size += h.size
