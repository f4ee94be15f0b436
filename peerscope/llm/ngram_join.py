"""Operator 5 -- n-gram Jaccard self-join with a count-vector R-tree.

A document's set is that of its distinct word n-grams, as 64-bit hashes.  The hashes are dealt to ``GROUPS``
groups; a document is the point of its group counts.  The intersection of two sets is at most the sum of the
smaller coordinates, so an R-tree over the points prunes: with a node's largest coordinates the sum bounds the
intersection with every set below it.  Pairs that survive at the leaves are verified on the sets.

An R-tree over all points would not prune (one box of a random group of texts spans the whole range in each of many
dimensions), nor could it be split over tasks, so the points are first cut into blocks, without loss:

1. *Signatures.*  Linked sets differ in at most d = floor(n / 9) hashes, n the smaller size (threshold 0.9).  The
   hash space is cut into m = 1.5 (d + 1) parts, so two linked sets agree in m - d parts at least; a set's key for a part is
   a hash of what it has there.  Keys have a level by how common they are (passages that many texts share have high
   ones).  A set keeps the keys up to the lowest level at which it has more than d of them, and only if it has not enough
   in all also those of its empty parts: of two linked sets the one with the lower limit shares one of its
   kept keys with the other, which keeps it too.  Levels come from a bounded sample of documents; any choice loses no
   link, it only decides how large blocks get.  m is a function of a size class; sets near the lower end of their class also have
   the keys of the class below.
2. *Edges.*  Each task collapses equal sets, finds the components of its sets and keys, and sends each key on once, with the smallest
   id of its component, and one edge for each other id; so a key of very many documents is one pair a flush, and two texts that
   share many keys are one edge.  Pairs travel as packed arrays, a row per bucket of the key space; a task joins its
   buckets (of bounded size) by key, one after the other, and sends only edges that connect what it has not connected yet.
   Texts that share most of their keys meet in every task, and each would send their edge; so this is done twice, first with the
   ``FIRST_KEYS`` keys of least hash of each set (at most so many edges a text, whatever the number of tasks), then with all
   keys and the components found first in place of the ids: what is left to send shares few keys.
3. *Blocks* are the connected components of these edges.  Linked sets share a key, so they share a block; a text that
   shares no key is done.  Equal sets are then one member (128-bit digest).
4. *R-tree on points.*  The blocks' points (no texts) go through the R-tree; components of the pairs whose bound reaches the
   link condition are the final, much smaller blocks.
5. *Verification.*  Only the texts in final blocks are read again, and pairs that the R-tree lets through are compared by
   their sets.  In both steps a block of more than the tile size is cut into bands of set sizes and these by hash into
   leaves; each pair of leaves whose sizes allow a link is a tile of bounded size; pairs already connected inside a tile are skipped, and only a spanning forest is returned.
6. Components of the links, joined back to the ids of equal sets.

Edge cases: texts without words and null texts have an empty set and link with nothing; fewer words than n are one
n-gram; repeated rows are equal sets; rows with a null id are returned with their set size and a null component;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import bounded_sample, byte_texts, map_text, mix64, release_memory, ship_package, small_batches, text_chunks, within
from peerscope.llm.graph import components
from peerscope.session import materialize

N_WORDS = 3
THRESHOLD = 0.9
GROUPS, MAX_GROUPS = 64, 4096
LEAF, FAN = 32, 8
CLASS_RATIO = 1.5
POINT_ROWS = 4096
TILE_ROWS = 1024
TILE_SIZE = 1_000_000
BUCKET_HASHES = 500_000
FLUSH_KEYS = 600_000
FIRST_KEYS = 8
STATE_IDS = 1_000_000
SAMPLE_DOCS = 20_000
COMMON = 3
NOTHING_COMMON = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_POWERS = mix64(np.arange(4096, dtype=np.uint64) + np.uint64(99)) | np.uint64(1)
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else (0x20 if b in b"\t\n\x0b\x0c\r" else b) for b in range(256))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z."""
    buf = np.frombuffer(b" " + text.translate(_LOWER) + b" ", dtype=np.uint8)
    space = buf == 0x20
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not edge.size:
        return np.zeros(0, dtype=np.uint64)
    starts = edge[0::2]
    begin = np.zeros(buf.size, dtype=np.int64)
    begin[starts] = starts
    place = np.arange(buf.size) - np.maximum.accumulate(begin)
    value = (buf + np.uint64(1)) * _POWERS[place & 4095]
    value += mix64(place >> 12) * (place > 4095)
    value[space] = 0
    return mix64(np.add.reduceat(value, starts))


def ngram_set(text: bytes, n: int = N_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the n-grams; the whole sequence if shorter."""
    w = word_hashes(text)
    if not w.size:
        return w
    k = min(n, w.size)
    h = np.full(w.size - k + 1, np.uint64(k))
    for j in range(k):
        h = mix64(h * _A + w[j:w.size - k + 1 + j] * (_B + np.uint64(2 * j)))
    return np.unique(h)


def _need(a, b, threshold: float = THRESHOLD):
    """Least intersection with which sets of these sizes are linked (100 * i >= 90 * union)."""
    t = round(threshold * 100)
    return -(-t * (a + b) // (100 + t))


class Classes:
    """Size classes and the number of parts of each, for a threshold."""

    def __init__(self, threshold: float = THRESHOLD):
        t = round(threshold * 100)
        self.t = t
        self.first = -(-t // (100 - t))         # below this size linked sets are equal sets
        self.ratio = max(CLASS_RATIO, 1.2 * 100 / t)

    def differ(self, n: int) -> int:
        """Most hashes in which sets are different that are linked, n the smaller size."""
        return (100 - self.t) * n // self.t

    def number(self, n: int) -> int:
        k = max(0, int(math.log(n / self.first) / math.log(self.ratio)))
        while n >= self.low(k + 1):
            k += 1
        while k and n < self.low(k):
            k -= 1
        return k

    def low(self, k: int) -> int:
        return math.ceil(self.first * self.ratio ** k)

    def parts(self, k: int) -> int:
        d = self.differ(self.low(k + 1) - 1) + 1
        return d + max(2, math.ceil(0.5 * d))

    def keys(self, s: np.ndarray, common: tuple[np.ndarray, np.ndarray] = NOTHING_COMMON) -> np.ndarray:
        """Keys that a set keeps; ``common``: sorted keys with their level (1 and up, other keys have level 0)."""
        n = s.size
        if n < self.first:
            return np.zeros(0, dtype=np.uint64)
        k = self.number(n)
        of = [k]
        if k and -(-self.t * n // 100) < self.low(k):       # smaller partners are in the class below
            of.append(k - 1)
        return np.concatenate([self._keys(s, c, common) for c in of])

    def _keys(self, s: np.ndarray, k: int, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        m = self.parts(k)
        mixed = mix64(s ^ _B)
        part = ((mixed >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        held, start = np.unique(part[order], return_index=True)
        sums = np.add.reduceat(mix64(mixed + _A)[order], start)
        own = mix64(sums ^ mix64(held.astype(np.uint64) + np.uint64(k << 40)))
        known, of = common
        level = np.zeros(own.size, dtype=np.int64)
        if known.size:
            at = np.searchsorted(known, own)
            at[at == known.size] = 0
            level = np.where(known[at] == own, of[at], 0)
        d = self.differ(s.size)
        if own.size > d:
            return own[level <= np.sort(level)[d]]
        # the parts in common with a linked set could all be empty ones
        empty = np.setdiff1d(np.arange(m), held)
        return np.concatenate((own, mix64(mix64(empty.astype(np.uint64) + np.uint64(k << 40)))))


def count_vector(s: np.ndarray) -> np.ndarray:
    """How many hashes of a set fall into each group.  The number of groups is a power of two of about an eighth of
    the set's size: with it random sets of any size have a bound of about 0.8 of their size."""
    groups = GROUPS
    while groups < min(MAX_GROUPS, s.size // 8):
        groups *= 2
    return np.bincount((s >> np.uint64(40)).astype(np.int64) % groups, minlength=groups).astype(np.int32)


class Points:
    """Count vectors of many sets, comparable at each number of groups: a group of fewer ones is the sum of
    those it holds.  ``coarse`` has all sets at the least number of groups; the R-tree is built on it."""

    def __init__(self, vectors: list[np.ndarray], sizes: np.ndarray):
        self.sizes = np.asarray(sizes, dtype=np.int64)
        self.groups = np.array([v.size for v in vectors], dtype=np.int64)
        self.levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}      # groups: (row of each set, or -1; matrix)
        for g in np.unique(np.append(self.groups, GROUPS)).tolist():
            held = np.flatnonzero(self.groups >= g)
            row = np.full(len(vectors), -1, dtype=np.int64)
            row[held] = np.arange(held.size)
            self.levels[g] = row, np.array([vectors[k].reshape(-1, g).sum(0) for k in held.tolist()], dtype=np.int32).reshape(held.size, g)
        self.coarse = self.levels[GROUPS][1]

    def at(self, g: int, own: np.ndarray) -> np.ndarray:
        """The vectors of ``own`` (which have at least ``g`` groups) with ``g`` groups."""
        if g not in self.levels:
            finer = min(x for x in self.levels if x > g)
            row, matrix = self.levels[finer]
            self.levels[g] = row, matrix.reshape(len(matrix), -1, g).sum(1, dtype=np.int32)
        row, matrix = self.levels[g]
        return matrix[row[own]]

    def near(self, p: int, other: Points, own: np.ndarray, threshold: float) -> np.ndarray:
        """Those of ``own`` (sets of ``other``) whose finest bound with set ``p`` reaches the link condition."""
        if not own.size:
            return own
        keep = np.zeros(own.size, dtype=bool)
        both = np.minimum(other.groups[own], self.groups[p])
        for g in np.unique(both).tolist():
            at = np.flatnonzero(both == g)
            bound = np.minimum(other.at(g, own[at]), self.at(g, np.array([p]))).sum(1)
            keep[at] = bound >= _need(other.sizes[own[at]], self.sizes[p], threshold)
        return own[keep]


def points_of(sets: list[np.ndarray]) -> Points:
    return Points([count_vector(s) for s in sets], np.array([s.size for s in sets]))


class RTree:
    """Packed R-tree over count vectors: boxes are kept as largest coordinates and the range of set sizes."""

    def __init__(self, held: Points):
        self.held = held
        points, sizes = self.points, self.sizes = held.coarse, held.sizes
        self.order = np.lexsort((*points.T[:4], sizes))
        self.levels = []        # from the leaves: (top coordinates, smallest size, largest size, first child, end)
        bounds = np.append(np.arange(0, len(points), LEAF), len(points))
        tops, low, high = points[self.order], sizes[self.order], sizes[self.order]
        while True:
            at = bounds[:-1]
            tops, low, high = np.maximum.reduceat(tops, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((tops, low, high, at, bounds[1:]))
            if len(at) == 1:
                break
            bounds = np.append(np.arange(0, len(at), FAN), len(at))

    def candidates(self, other: Points, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
        """(point, queries whose bound reaches the link condition), by way of the boxes."""
        t = round(threshold * 100)
        queries, sizes = other.coarse, other.sizes
        stack = [(len(self.levels) - 1, 0, np.arange(len(queries)))]
        while stack:
            level, node, own = stack.pop()
            tops, low, high, first, end = (x[node] for x in self.levels[level])
            own = own[(100 * sizes[own] >= t * low) & (100 * high >= t * sizes[own])]
            if own.size:
                own = own[np.minimum(queries[own], tops).sum(1) >= _need(sizes[own], low, threshold)]
            if not own.size:
                continue
            if level:
                stack += [(level - 1, c, own) for c in range(first, end)]
                continue
            for p in self.order[first:end].tolist():
                near = own[np.minimum(queries[own], self.points[p]).sum(1) >= _need(sizes[own], self.sizes[p], threshold)]
                near = self.held.near(p, other, near, threshold)
                if near.size:
                    yield p, near


class _Labels:
    """Component labels of the members of a tile as arrays; members may stand on both sides."""

    def __init__(self, left: list[int], right: list[int]):
        self.ids, at = np.unique(np.array([*left, *right], dtype=np.int64), return_inverse=True)
        self.left, self.right = at[:len(left)], at[len(left):]
        self.label = np.arange(self.ids.size)

    def apart(self, p: int, near: np.ndarray) -> np.ndarray:
        """Members of ``near`` (right side) not yet connected with ``p`` (left side)."""
        return near[self.label[self.right[near]] != self.label[self.left[p]]]

    def connect(self, p: int, q: int) -> tuple[int, int]:
        a, b = self.left[p], self.right[q]
        self.label[self.label == self.label[b]] = self.label[a]
        return int(self.ids[a]), int(self.ids[b])


def near_pairs(left: list[int], points: Points, right: list[int], other: Points, threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """A spanning forest of the pairs whose bound reaches the link condition."""
    if not left or not right:
        return []
    labels, out = _Labels(left, right), []
    for p, near in RTree(points).candidates(other, threshold):
        near = labels.apart(p, near)
        while near.size:
            out.append(labels.connect(p, int(near[0])))
            near = labels.apart(p, near)
    return out


def links(left: list[int], left_sets: list[np.ndarray], right: list[int], right_sets: list[np.ndarray],
          threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """A spanning forest of the links between the two sides (which may be the same lists)."""
    if not left or not right:
        return []
    labels, out, t = _Labels(left, right), [], round(threshold * 100)
    points = points_of(left_sets)
    for p, near in RTree(points).candidates(points if right_sets is left_sets else points_of(right_sets), threshold):
        s = left_sets[p]
        near = labels.apart(p, near)
        while near.size:
            o = right_sets[near[0]]
            small, big = (s, o) if s.size <= o.size else (o, s)
            at = np.searchsorted(big, small)
            at[at == big.size] = 0
            common = int((big[at] == small).sum())
            if 100 * common >= t * (s.size + o.size - common):
                out.append(labels.connect(p, int(near[0])))
                near = labels.apart(p, near[1:])
            else:
                near = near[1:]
    return out


def _digest(s: np.ndarray) -> tuple[int, int]:
    if not s.size:
        return 0, 0
    return int(np.bitwise_xor.reduce(mix64(s))), int(mix64(s * _A).sum(dtype=np.uint64))


def _sizes_table(docs: DataFrame, n: int, threshold: float) -> DataFrame:
    """doc_id, n_shingles, the set's 128-bit digest, its point and the keys it keeps (8 bytes each)."""
    classes = Classes(threshold)
    common = docs.sparkSession.sparkContext.broadcast(_common_keys(docs, n, threshold))

    def step(chunk: pa.RecordBatch) -> dict:
        sets = [ngram_set(t, n) for t in byte_texts(chunk)]
        own = [_digest(s) for s in sets]
        digests = np.array(own, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        keys = {d: classes.keys(s, common.value).tobytes() for d, s in dict(zip(own, sets)).items()}
        return {"doc_id": chunk.column("doc_id"), "n_shingles": [s.size for s in sets], "d1": digests[:, 0], "d2": digests[:, 1],
                "point": [count_vector(s).astype("<i4").tobytes() for s in sets], "keys": [keys[d] for d in own]}

    return map_text(docs, step, "doc_id long, n_shingles long, d1 long, d2 long, point binary, keys binary")


def _common_keys(docs: DataFrame, n: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys that ``COMMON`` or more different sets of a sample of at most ``SAMPLE_DOCS`` documents have, with levels that
    rise by one as the number of sets doubles; so at most ``SAMPLE_DOCS / COMMON`` times the keys of a document come to
    the driver."""
    classes = Classes(threshold)
    ids = bounded_sample(docs.select("doc_id").where(F.col("doc_id").isNotNull()), SAMPLE_DOCS, "doc_id").distinct()

    def step(chunk: pa.RecordBatch) -> dict:
        sets = {_digest(s): s for s in (ngram_set(t, n) for t in byte_texts(chunk))}
        keys = [(d, k) for d, s in sets.items() for k in classes.keys(s).tolist()]
        return {"key": np.array([k for _, k in keys], dtype=np.uint64).view(np.int64), "own": np.array([d[0] for d, _ in keys], dtype=np.uint64).view(np.int64)}

    keys = map_text(docs.join(F.broadcast(ids), "doc_id"), step, "key long, own long").distinct()
    found = keys.groupBy("key").count().where(F.col("count") >= COMMON).toPandas()
    known = found["key"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(known)
    return known[order], 1 + np.log2(found["count"].to_numpy(dtype=np.float64)[order] / COMMON).astype(np.int64)


def _forest(keys: np.ndarray, ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Connected components of the (key, id) pairs and the edges between ids: the distinct keys, the smallest id of the component of each,
    and one edge (id, that smallest id) for each other id.  So there are never more edges than ids, however many keys two of them share."""
    own, place = np.unique(keys, return_inverse=True)
    nodes, at = np.unique(np.concatenate((ids, edges.ravel())), return_inverse=True)
    # an edge is a key of its own with two members
    group = np.concatenate((place, own.size + np.repeat(np.arange(len(edges)), 2)))
    order = np.argsort(group, kind="stable")
    group, at = group[order], at[order]
    start = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if group.size else np.zeros(0, dtype=np.int64)
    size = np.diff(np.append(start, group.size))
    label = np.arange(nodes.size)
    while group.size:
        least = np.minimum.reduceat(label[at], start)
        after = label.copy()
        np.minimum.at(after, label[at], np.repeat(least, size))     # a root joins the smallest root it meets
        while True:
            up = after[after]
            if (up == after).all():
                break
            after = up
        after = after[label]
        if (after == label).all():
            break
        label = after
    root = nodes[label]
    found = np.flatnonzero(root != nodes)
    pivot = root[at[start[:own.size]]] if own.size else np.zeros(0, dtype=np.int64)
    return own, pivot, np.stack((nodes[found], root[found]), 1)


class _Roots:
    """Components that a task has found so far.  A text of many keys is met in many buckets; what is connected already is not
    sent again.  Beyond ``STATE_IDS`` ids the state starts anew, which may repeat an edge but loses none."""

    def __init__(self) -> None:
        self.ids, self.root = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def _of(self, ids: np.ndarray, nodes: np.ndarray, roots: np.ndarray) -> np.ndarray:
        at = np.searchsorted(nodes, ids)
        at[at == nodes.size] = 0
        return np.where(nodes[at] == ids, roots[at], ids) if nodes.size else ids

    def add(self, keys: np.ndarray, ids: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """The edges that connect what was apart."""
        if self.ids.size > STATE_IDS:
            self.__init__()
        new = _forest(keys, self._of(ids, self.ids, self.root), self._of(edges.ravel(), self.ids, self.root).reshape(-1, 2))[2]
        if len(new):
            old, up = new[:, 0], new[:, 1]          # sorted by the first, each once
            nodes = np.union1d(self.ids, new.ravel())
            self.ids, self.root = nodes, self._of(self._of(nodes, self.ids, self.root), old, up)
        return new


def _key_edges(sets: DataFrame, buckets: int, first: int | None = None) -> DataFrame:
    """Edges (a, b) that connect the ids of ``sets`` (doc_id, d1, d2, keys) with a key in common.  ``first``: of the keys of each set
    only so many, those of least hash."""
    keep = np.uint64((1 << 40) - 1)

    def flush(keys: list, ids: list) -> Iterator[pa.RecordBatch]:
        own, pivot, edges = _forest(np.concatenate(keys), np.concatenate(ids), np.zeros((0, 2), dtype=np.int64))
        bucket = ((own >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)     # follows the order of the keys
        cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if own.size else np.zeros(0, dtype=np.int64)
        ends = np.append(cut[1:], own.size)
        # 40 bits of a key in its bucket: a chance collision only makes a block larger
        low = np.ascontiguousarray((own * _A & keep)).view(np.uint8).reshape(-1, 8)[:, :5]
        blobs = [low[a:b].tobytes() + pivot[a:b].tobytes() for a, b in zip(cut, ends)]
        at = bucket[cut].tolist()
        if len(edges):
            at.append(int(edges[0, 0]) % buckets)
            blobs.append(edges.astype(np.int64).tobytes())
        marks = [False] * len(cut) + [True] * bool(len(edges))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(marks, pa.bool_()), pa.array(blobs, pa.binary())],
                                         names=["bucket", "edges", "blob"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, held = [], [], 0
        equal: dict[tuple[int, int], tuple[int, np.ndarray]] = {}      # of the sets since the last flush
        for chunk in text_chunks(batches, "keys", FLUSH_KEYS):         # an eighth of a flush, as a key has 8 bytes
            for doc, d1, d2, blob in zip(*(chunk.column(c).to_pylist() for c in ("doc_id", "d1", "d2", "keys"))):
                seen = equal.get((d1, d2))
                if seen is None:
                    k = np.frombuffer(blob, dtype=np.uint64)
                    if first and k.size > first:
                        k = k[np.argsort(mix64(k), kind="stable")[:first]]
                    equal[d1, d2] = doc, k
                elif seen[0] == doc:
                    continue
                else:                   # one key ties a copy to the set that has sent them all
                    k = seen[1][:1]
                keys.append(k)
                ids.append(np.full(k.size, doc, dtype=np.int64))
                held += k.size
            if held > FLUSH_KEYS:
                yield from flush(keys, ids)
                keys, ids, held, equal = [], [], 0, {}
        if held:
            yield from flush(keys, ids)
        del keys, ids, equal
        release_memory()

    def unpack(rows: list[tuple[bool, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, ids, edges = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)], [np.zeros((0, 2), dtype=np.int64)]
        for mark, blob in rows:
            if mark:
                edges.append(np.frombuffer(blob, dtype=np.int64).reshape(-1, 2))
                continue
            size = len(blob) // 13
            wide = np.zeros((size, 8), dtype=np.uint8)
            wide[:, :5] = np.frombuffer(blob[:5 * size], dtype=np.uint8).reshape(-1, 5)
            keys.append(wide.view(np.uint64).ravel())
            ids.append(np.frombuffer(blob[5 * size:], dtype=np.int64))
        return np.concatenate(keys), np.concatenate(ids), np.concatenate(edges)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, now, rows = _Roots(), None, []

        def found() -> Iterator[pa.RecordBatch]:
            new = known.add(*unpack(rows))
            if len(new):
                yield pa.RecordBatch.from_arrays([pa.array(new[:, 0]), pa.array(new[:, 1])], names=["a", "b"])

        for batch in batches:
            for bucket, mark, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "edges", "blob"))):
                if bucket != now and rows:
                    yield from found()
                    rows = []
                now = bucket
                rows.append((mark, blob))
        if rows:
            yield from found()
        del known, rows
        release_memory()

    packed = sets.mapInArrow(send, "bucket long, edges boolean, blob binary")
    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(join, "a long, b long")


def _candidate_edges(table: DataFrame) -> DataFrame:
    """Edges (a, b) whose components hold every link between the sets of ``table``."""
    # sets below the first class have no keys: they link with equal ones only
    sets = table.where(F.col("doc_id").isNotNull() & (F.length("keys") > 0))
    rows, total = sets.agg(F.count(F.lit(1)), F.sum("n_shingles")).first()
    own = sets.select("doc_id", "d1", "d2", "keys")
    few, all_ = (max(1, -(-x // BUCKET_HASHES)) for x in (FIRST_KEYS * rows, total or 0))
    found = materialize(components(_key_edges(own, few, FIRST_KEYS)), "first_blocks")
    named = own.join(within(found.withColumnRenamed("node", "doc_id")), "doc_id", "left")
    rest = _key_edges(named.select(F.coalesce("component", "doc_id").alias("doc_id"), "d1", "d2", "keys"), all_)
    return rest.unionAll(found.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")))


def _tiles(blocks: DataFrame, threshold: float, rows: int, hashes: int | None = None) -> DataFrame:
    """The columns of ``blocks`` and (i, j, side): the tiles each member takes part in.

    A block that fits is one tile.  A larger one is cut into bands by set size, a factor of just over 1 / threshold wide, so
    that linked sets are in one band or in neighbouring ones, and each band into leaves by hash.  The tiles are the pairs of
    leaves of one band or of neighbouring bands; ``i`` and ``j`` number the leaves of the lower and the higher one."""
    def need(*by: str) -> DataFrame:
        size = blocks if "band" not in by else banded
        n = F.ceil(F.count(F.lit(1)) / rows)
        if hashes:
            n = F.greatest(n, F.ceil(F.sum("n_shingles") / hashes))
        return size.groupBy(*by).agg(n.cast("long").alias("leaves"))

    width = 1.01 * math.log(100 / round(threshold * 100))
    band = F.when(F.col("leaves") > 1, F.floor(F.ln("n_shingles") / F.lit(width))).otherwise(F.lit(0)).cast("long")
    banded = blocks.join(need("block"), "block").withColumn("band", band).drop("leaves")
    bands = need("block", "band")
    own = banded.join(bands, ["block", "band"]).withColumn("leaf", F.pmod(F.xxhash64("rep", F.lit(5)), F.col("leaves"))).drop("leaves")
    near = own.withColumn("to", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    near = near.join(bands.withColumnRenamed("band", "to"), ["block", "to"])
    other = near.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("leaves") - 1)))
    mine, theirs = (F.shiftleft(F.col(x), 32) + F.col(y) for x, y in (("band", "leaf"), ("to", "other")))
    return other.select(*blocks.columns, F.least(mine, theirs).alias("i"), F.greatest(mine, theirs).alias("j"), (mine > theirs).alias("side"))


def _sides(table: pa.Table) -> tuple[list[int], list[int], list[int]]:
    """Ids of the tile's rows, and the rows of its two sides (the same in a diagonal tile)."""
    reps, sides = table.column("rep").to_pylist(), table.column("side").to_pylist()
    left = [k for k, s in enumerate(sides) if not s]
    same = table.column("i")[0].as_py() == table.column("j")[0].as_py()
    return reps, left, left if same else [k for k, s in enumerate(sides) if s]


def _edges(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _point_tile(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        reps, left, right = _sides(table)
        vectors = [np.frombuffer(v, dtype="<i4") for v in table.column("point").to_pylist()]
        sizes = table.column("n_shingles").to_numpy()
        one = Points([vectors[k] for k in left], sizes[left])
        two = one if right is left else Points([vectors[k] for k in right], sizes[right])
        return _edges(near_pairs([reps[k] for k in left], one, [reps[k] for k in right], two, threshold))

    return run


def _join_tile(n: int, threshold: float):
    def run(table: pa.Table) -> pa.Table:
        reps, left, right = _sides(table)
        sets = [ngram_set(t or b"", n) for t in table.column("text").to_pylist()]
        one = [sets[k] for k in left]
        two = one if right is left else [sets[k] for k in right]
        return _edges(links([reps[k] for k in left], one, [reps[k] for k in right], two, threshold))

    return run


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = N_WORDS,
                       threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id (long), n_shingles and component_id, the smallest id reachable by links."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    table = materialize(_sizes_table(rows, n, threshold), "ngram_sets")
    real = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    reps = table.where(real).groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    with small_batches(docs.sparkSession):      # the keys of a set may be as long as its text
        block_of = materialize(components(_candidate_edges(table)), "blocks")
    # the distinct sets in blocks, with their points
    nodes = block_of.select(F.col("node").alias("doc_id"), F.col("component").alias("block"))
    sets = table.where(real).join(within(nodes), "doc_id").groupBy("d1", "d2").agg(
        F.min("block").alias("block"), F.first("n_shingles").alias("n_shingles"), F.first("point").alias("point"))
    members = materialize(reps.join(sets, ["d1", "d2"]).select("rep", "block", "n_shingles", "point"), "members")
    near = _tiles(members, threshold, POINT_ROWS).groupBy("block", "i", "j").applyInArrow(_point_tile(threshold), "a long, b long")
    final = materialize(components(near), "final_blocks").select(F.col("node").alias("rep"), F.col("component").alias("block"))
    sized = materialize(members.select("rep", "n_shingles").join(within(final), "rep"), "final_members")
    tiles = materialize(_tiles(sized, threshold, TILE_ROWS, TILE_SIZE).drop("n_shingles"), "tiles")
    wanted = rows.select(F.col("doc_id").alias("rep"), F.col("text").cast("binary").alias("text"))
    found = wanted.join(within(tiles), "rep").groupBy("block", "i", "j").applyInArrow(_join_tile(n, threshold), "a long, b long")
    label = components(found)
    named = reps.join(label, reps["rep"] == label["node"], "left").select("d1", "d2", F.coalesce("component", "rep").alias("found"))
    return table.join(named, ["d1", "d2"], "left").select(
        "doc_id", "n_shingles", F.when(real, F.col("found")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """``docs`` with the smallest id of each group of linked documents, all columns; rows that repeat an id count as
    copies of it, rows without an id or without words all stay."""
    found = materialize(jaccard_components(docs, doc_id, text, **kw), "components")
    rejected = found.where("doc_id <> component_id").select(F.col("doc_id").alias(doc_id)).distinct()
    kept = docs.join(within(materialize(rejected, "rejected")), doc_id, "left_anti")
    if found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():
        kept = kept.where(F.col(doc_id).isNotNull()).dropDuplicates([doc_id]).unionAll(kept.where(F.col(doc_id).isNull()))
    return kept.select(*docs.columns)


def brute_force(texts: dict[int, str], n: int = N_WORDS, threshold: float = THRESHOLD) -> dict[int, tuple[int, int]]:
    """{id: (set size, component)} by comparing all pairs, for tests."""
    sets = {}
    for k, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[k] = {tuple(w[j:j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    ids, label = sorted(sets), {k: k for k in sets}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if label[b] < label[a] and sets[a] and sets[b]:
                    i = len(sets[a] & sets[b])
                    if 100 * i >= round(threshold * 100) * (len(sets[a]) + len(sets[b]) - i):
                        label[a], changed = label[b], True
    return {k: (len(sets[k]), label[k]) for k in ids}


ORACLE_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
gram AS (
  SELECT DISTINCT doc_id, array_to_string(w[k : k + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS k FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y FROM pair JOIN size s ON x = s.doc_id JOIN size t ON y = t.doc_id WHERE 100 * i >= 90 * (s.n + t.n - i)),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM doc UNION SELECT reach.doc_id, link.y FROM reach JOIN link ON reach.r = link.x)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, m.c AS component_id
FROM doc d LEFT JOIN size s USING (doc_id) JOIN (SELECT doc_id, min(r) AS c FROM reach GROUP BY doc_id) m USING (doc_id)
"""
