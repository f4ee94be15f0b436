"""Operator 3 -- benchmark decontamination with a generalised suffix automaton.

Test items are normalised to word ids and put into one generalised suffix automaton
(Blumer et al., 1985).  Document words stream through it; the state keeps the longest
suffix of the words read that is a substring of some item, and its length.  A position
whose length reaches ``window`` ends an occurrence of a window; items shorter than the
window count as one window each and are found on the suffix-link chain.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, so UTF-8 bytes can be
handled as they are: one ``bytes.translate`` and ``bytes.split``.  Before the automaton runs, words
outside the items' vocabulary and word pairs that no item has cut the text into pieces;
only pieces long enough for a window are streamed.  This loses no occurrence.

Plan: a narrow ``mapInArrow`` over (id, text), no shuffle.  The automaton is broadcast; its
size is bounded by ``MAX_BLOCK_WORDS``.  A larger test set is cut into blocks by a hash of its id
and the documents pass the blocks one after another, so every item is always searched.

Edge cases: a null text has no words; an item without words or with a null id is never found;
items with equal texts are all reported; repeated documents are handled row by row; empty tables
give an empty result or zero hits; columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import byte_texts, map_text
from peerscope.session import materialize

WINDOW = 10
MAX_BLOCK_WORDS = 100_000
_KEEP = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_TABLE = bytes(ord(chr(b).lower()) if 0x41 <= b <= 0x5A else (b if b in _KEEP else 0x20) for b in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class SuffixAutomaton:
    """Generalised suffix automaton over word ids, with the window and short-item marks."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        seqs = []
        for item, words in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            if ids:
                seqs.append((item, ids))
                last = 0
                for c in ids:
                    last = self._extend(last, c)
        order = sorted(range(len(self.len)), key=self.len.__getitem__)
        # state that holds the suffix of exactly `window` words, -1 where shorter
        self.at_window = [-1] * len(self.len)
        for s in order[1:]:
            if self.len[s] >= window:
                up = self.link[s]
                self.at_window[s] = s if self.len[up] < window else self.at_window[up]
        self.items: dict[int, set[int]] = {}
        self.short: dict[int, list[tuple[int, set[int]]]] = {}
        self.shortest = min([window, *(len(ids) for _, ids in seqs)])
        for item, ids in seqs:
            s = 0
            for p, c in enumerate(ids, 1):
                s = self.next[s][c]
                if p >= window:
                    self.items.setdefault(self.at_window[s], set()).add(item)
            if len(ids) < window:
                marks = self.short.setdefault(s, [])
                for m, own in marks:
                    if m == len(ids):
                        own.add(item)
                        break
                else:
                    marks.append((len(ids), {item}))
        # nearest proper ancestor with a short item
        self.up_short = [-1] * len(self.len)
        for s in order[1:]:
            up = self.link[s]
            self.up_short[s] = up if up in self.short else self.up_short[up]
        self.pairs = np.unique(np.array([a << 32 | b for _, ids in seqs for a, b in zip(ids, ids[1:])], dtype=np.int64))

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(length)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        twin = len(length)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = twin
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = twin
            p = link[p]
        return twin

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged hit spans [a, b) in words, and the items with an occurring window."""
        n, least = len(words), self.shortest
        if n < least or not self.vocab:
            return [], set()
        ids = np.fromiter(map(self.vocab.get, words, repeat(-1)), dtype=np.int64, count=n)
        known = ids >= 0
        if least > 1:
            if not known.any():
                return [], set()
            keys = (ids[:-1] << 32) | ids[1:]
            joined = known[:-1] & known[1:]
            at = np.flatnonzero(joined)
            if self.pairs.size == 0 or at.size == 0:
                return [], set()
            found = np.searchsorted(self.pairs, keys[at])
            found[found == self.pairs.size] = 0
            joined[at] = self.pairs[found] == keys[at]
            edge = np.flatnonzero(np.diff(np.concatenate(([0], joined.view(np.int8), [0]))))
            pieces = [(a, b + 1) for a, b in edge.reshape(-1, 2).tolist() if b + 1 - a >= least]
        else:
            edge = np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0]))))
            pieces = edge.reshape(-1, 2).tolist()
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        nxt, link, length, window = self.next, self.link, self.len, self.window
        short, up_short = self.short, self.up_short
        for a, b in pieces:
            s = run = 0
            for p, c in enumerate(ids[a:b].tolist(), a):
                while s and c not in nxt[s]:
                    s = link[s]
                    run = length[s]
                s = nxt[s].get(c, 0)
                run = run + 1 if s else 0
                if run >= window:
                    spans.append((p + 1 - window, p + 1))
                    items |= self.items[self.at_window[s]]
                if short and s:
                    for m, own in short.get(s, ()):
                        if run >= m:
                            spans.append((p + 1 - m, p + 1))
                            items |= own
                    t = up_short[s]
                    while t != -1:
                        for m, own in short[t]:
                            spans.append((p + 1 - m, p + 1))
                            items |= own
                        t = up_short[t]
        return merge_spans(spans), items


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def remove_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the bytes from the first to the last word of each span."""
    places = [m.span() for m in _WORD.finditer(text.translate(_TABLE))]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:places[a][0]])
        at = places[b - 1][1]
    out.append(text[at:])
    return b"".join(out)


SCHEMA = "n_words long, hits array<struct<start:int,stop:int>>, items array<long>"


def _blocks(benchmark: DataFrame, item: str, text: str, max_words: int):
    """Lists of (id, words) whose size is bounded, and whether it is the last; one list unless the test set is large."""
    rows = benchmark.where(F.col(item).isNotNull() & F.col(text).isNotNull()).select(
        F.col(item).cast("long").alias("item"), F.col(text).cast("binary").alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // (4 * max_words)))     # about five bytes a word, so a block stays below its bound
    for b in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item"), F.lit(n)) == b)
        yield [(r["item"], words_of(bytes(r["text"]))) for r in part.toLocalIterator()], b == n - 1


def scan(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
         max_block_words: int = MAX_BLOCK_WORDS, carry: tuple[str, ...] = (), cut: bool = False) -> DataFrame:
    """Every row of ``docs`` as (row, text, n_words, hits, items): a struct of doc_id and the columns of ``carry``, merged
    hit spans in word positions and the sorted ids of the items with an occurring window.  ``cut``: the text comes back
    without the hit spans; one step does both, as a second one would be another Python worker in every core."""
    spark = docs.sparkSession
    own = [F.col(doc_id).alias("doc_id"), *(F.col(c) for c in carry if c not in (doc_id, text))]
    out = docs.select(F.struct(*own).alias("row"), F.col(text).alias("text"))
    kind = out.schema["row"].dataType.simpleString()
    first = True
    for items, last in _blocks(benchmark, item_id, item_text, max_block_words):
        held = spark.sparkContext.broadcast(SuffixAutomaton(items, window))
        if not first:
            out = materialize(out, "decontaminate")

        def step(chunk: pa.RecordBatch, first=first, held=held, cut=cut and last) -> dict:
            sam = held.value
            n, hits, found, changed = [], [], [], {}
            before = None if first else list(zip(chunk.column("hits").to_pylist(), chunk.column("items").to_pylist()))
            for k, t in enumerate(byte_texts(chunk)):
                words = words_of(t)
                spans, items = sam.scan(words)
                if before:
                    spans = merge_spans(spans + [(x["start"], x["stop"]) for x in before[k][0]])
                    items |= set(before[k][1])
                n.append(len(words))
                hits.append([{"start": a, "stop": b} for a, b in spans])
                found.append(sorted(items))
                if cut and spans:
                    changed[k] = remove_spans(t, spans).decode()
            texts = chunk.column("text")
            if changed:
                texts = [changed.get(k, t) for k, t in enumerate(texts.to_pylist())]
            return {"row": chunk.column("row"), "text": texts, "n_words": n, "hits": hits, "items": found}

        out = map_text(out, step, f"row {kind}, text string, {SCHEMA}")
        first = False
    return out


def _n_hit():
    return F.aggregate("hits", F.lit(0).cast("long"), lambda acc, x: acc + (x["stop"] - x["start"]))


def report(scanned: DataFrame) -> DataFrame:
    """The contract's columns from ``scan``'s output."""
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return scanned.select("row.doc_id", "n_words", _n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                          F.sha2(names, 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, max_coverage: float = 0.5, max_hit_words: int | None = None,
                  window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, all columns, without test passages: hit spans are cut out of the text; a document is dropped when
    hits cover more than ``max_coverage`` of its words or more than ``max_hit_words`` words.  Clean documents come back
    unchanged; a column ``n_chars`` follows the text."""
    scanned = scan(docs, benchmark, doc_id, text, window=window, carry=tuple(docs.columns), cut=True)
    hit = _n_hit()
    keep = hit <= F.col("n_words") * F.lit(max_coverage)
    if max_hit_words is not None:
        keep = keep & (hit <= max_hit_words)
    changed = F.size("hits") > 0
    done = scanned.where(keep | ~changed).select("row", "text", changed.alias("changed"))
    cols = []
    for c in docs.columns:
        if c == text:
            cols.append(F.col("text").alias(c))
        elif c == "n_chars":
            old = F.col("row").getField(c)
            cols.append(F.when(F.col("changed"), F.length("text").cast("long")).otherwise(old).cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append(F.col("row").getField("doc_id" if c == doc_id else c).alias(c))
    return done.select(*cols)


def brute_force(docs: list[tuple], items: list[tuple], window: int = WINDOW) -> dict:
    """Plain check for tests: {doc_id: (n_words, hit positions, items)} by comparing all windows."""
    out = {}
    grams: dict[tuple, set] = {}
    for item, text in items:
        w = words_of((text or "").encode())
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            grams.setdefault(tuple(w[k:k + size]), set()).add(item)
    sizes = sorted({len(g) for g in grams})
    for doc, text in docs:
        w = words_of((text or "").encode())
        hit, found = set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                own = grams.get(tuple(w[k:k + size]))
                if own:
                    hit.update(range(k, k + size))
                    found |= own
        out[doc] = (len(w), hit, found)
    return out


ORACLE_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[k : k + least(10, len(w)) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
place AS (
  SELECT doc_id, size, k, array_to_string(w[k : k + size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM doc, sizes WHERE len(w) >= size)),
hit AS (SELECT p.doc_id, p.k, p.size, x.item_id FROM place p JOIN win x ON p.size = x.size AND p.gram = x.gram),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM hit) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
          FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(p.n_hit, 0)::BIGINT AS n_hit, coalesce(f.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(f.names, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN pos p USING (doc_id) LEFT JOIN found f USING (doc_id)
"""


def items_digest(items) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
