"""Operator 1 -- token counts by rank-synchronous array merging.

The distinct pre-tokens of a chunk of texts are held as one ragged numpy array of symbol ids.  In every
round each sequence finds the lowest rank among its adjacent pairs and merges all occurrences of that
pair at once, left to right; sequences without a mergeable pair leave the array and their remaining
symbols are counted.  A merge only makes pairs of a higher rank (a pair that contains a symbol is learned
after the symbol), so merging all occurrences at once gives what merging one by one gives.

Plan: a narrow ``mapInArrow`` over (id, text); no shuffle.  The vocabulary file is read once per task.
Counts of words seen before are kept by hash in a table bounded by ``CACHE_BITS``.

Edge cases: null and empty texts have no bytes and no tokens; repeated rows are counted each; strings of
added special tokens inside a text are one token each, as in the library's default; a text of any length
is counted whole (very long ones in independent segments); an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import map_text
from peerscope.llm.pieces import Pretokens, WordTable, class_table, segments

LIMIT = 512
CHUNK_BYTES = 1 << 20
BATCH_WORDS = 8192
BATCH_SYMBOLS = 1 << 17
CACHE_BITS = 22
_NONE = np.int32(1 << 30)


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of every byte in a byte-level vocabulary: printable Latin-1 bytes stand for
    themselves, the others follow from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return out


class RankMerger:
    """Symbol counts of pre-tokens under a byte-level pair vocabulary (a ``tokenizers`` JSON file)."""

    _BITS = 18

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        alphabet = byte_alphabet()
        self.first = np.array([vocab[alphabet[b]] for b in range(256)], dtype=np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        self.made_by_rank = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        # open addressing: the pairs still without a slot move one slot on, until all have one
        self.slots = np.full(1 << self._BITS, -1, dtype=np.int64)
        self.slot_rank = np.full(1 << self._BITS, _NONE, dtype=np.int32)
        rank = np.arange(keys.size, dtype=np.int32)
        at, left = self._slot(keys), np.arange(keys.size)
        while left.size:
            free = self.slots[at[left]] == -1
            slot, first = np.unique(at[left[free]], return_index=True)
            won = left[free][first]
            self.slots[slot], self.slot_rank[slot] = keys[won], rank[won]
            left = np.setdiff1d(left, won)
            at[left] = (at[left] + 1) & ((1 << self._BITS) - 1)
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._BITS)).view(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        want = (left.astype(np.int64) << 32) | right
        at = self._slot(want)
        held = self.slots[at]
        out = np.where(held == want, self.slot_rank[at], _NONE)
        on = np.flatnonzero((held != want) & (held != -1))
        while on.size:
            at[on] = (at[on] + 1) & ((1 << self._BITS) - 1)
            held = self.slots[at[on]]
            hit = held == want[on]
            out[on[hit]] = self.slot_rank[at[on[hit]]]
            on = on[~hit & (held != -1)]
        return out

    def merge(self, words: list[bytes]) -> np.ndarray:
        """Surviving symbols of each (non-empty) word."""
        out = np.zeros(len(words), dtype=np.int64)
        start = 0
        while start < len(words):      # batches of bounded size
            stop, size = start, 0
            while stop < len(words) and stop - start < BATCH_WORDS and (size == 0 or size + len(words[stop]) <= BATCH_SYMBOLS):
                size += len(words[stop])
                stop += 1
            out[start:stop] = self._merge(words[start:stop])
            start = stop
        return out

    def _merge(self, words: list[bytes]) -> np.ndarray:
        lens = np.fromiter(map(len, words), dtype=np.int32, count=len(words))
        out = np.zeros(len(words), dtype=np.int64)
        sym = self.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
        seq = np.arange(len(words))         # the words that are still in the arrays
        ends = np.cumsum(lens)
        rank = np.full(sym.size, _NONE, dtype=np.int32)
        rank[:-1] = self._ranks(sym[:-1], sym[1:])
        rank[ends - 1] = _NONE
        while seq.size:
            starts = ends - lens
            low = np.minimum.reduceat(rank, starts)
            done = low == _NONE
            if done.any():
                out[seq[done]] = lens[done]
                keep = np.repeat(~done, lens)
                sym, rank = sym[keep], rank[keep]
                seq, low, lens = seq[~done], low[~done], lens[~done]
                if not seq.size:
                    break
                ends = np.cumsum(lens)
            hit = rank == np.repeat(low, lens)
            at = np.flatnonzero(hit)
            near = np.diff(at) == 1
            if near.any():      # of adjacent occurrences (a a a) every other one merges, from the left
                fresh = np.concatenate(([True], ~near))
                order = np.arange(at.size)
                run = np.maximum.accumulate(np.where(fresh, order, 0))
                at = at[(order - run) % 2 == 0]
            sym[at] = self.made_by_rank[rank[at]]
            keep = np.ones(sym.size, dtype=bool)
            keep[at + 1] = False
            lost = np.searchsorted(at, ends)        # occurrences up to the end of each sequence
            lens = lens - np.diff(lost, prepend=0).astype(np.int32)
            ends = np.cumsum(lens)
            new = at - np.arange(at.size)           # places after the removal
            sym, rank = sym[keep], rank[keep]
            touched = np.concatenate((new, new[new > 0] - 1))
            touched = touched[touched + 1 < sym.size]
            rank[new] = _NONE
            rank[touched] = self._ranks(sym[touched], sym[touched + 1])
            rank[ends - 1] = _NONE
        return out

    def count_texts(self, texts: list[str], table: np.ndarray, cache: WordTable) -> np.ndarray:
        """Tokens of each text.  ``cache``: symbols by a word's hash."""
        out = np.zeros(len(texts), dtype=np.int64)
        parts: list[str] = []
        owner: list[int] = []
        for k, t in enumerate(texts):
            if self.special is not None and "<" in t and (found := self.special.findall(t)):
                out[k] += len(found)
                own = [s for x in self.special.split(t) for s in segments(x)]
            else:
                own = segments(t)
            parts += own
            owner += [k] * len(own)
        cut = Pretokens(parts, table) if parts else None
        if cut is None or not cut.starts.size:
            return out
        n = cache.find(cut.hashes)
        missing = np.flatnonzero(n < 0)
        if missing.size:
            new, first, number = np.unique(cut.hashes[missing], return_index=True, return_inverse=True)
            got = self.merge([cut.word(k).encode() for k in missing[first].tolist()]).astype(np.int32)
            n[missing] = got[number]
            if cache.full():
                cache.clear()
            cache.add(new, got)
        out += np.bincount(np.array(owner)[cut.owner], weights=n, minlength=len(texts)).astype(np.int64)
        return out


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).  ``path`` must
    exist on every worker."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    table = docs.sparkSession.sparkContext.broadcast(class_table())     # 1.1 MB, fixed

    def setup():
        return RankMerger(path), WordTable(CACHE_BITS)

    def step(chunk: pa.RecordBatch, state) -> dict:
        merger, cache = state
        texts = [t or "" for t in chunk.column("text").to_pylist()]
        n = merger.count_texts(texts, table.value, cache)
        return {"doc_id": chunk.column("doc_id"), "n_bytes": [len(t.encode()) for t in texts], "n_tokens": n,
                "over_limit": n > limit}

    return map_text(rows, step, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean", setup=setup,
                    max_bytes=CHUNK_BYTES)
