"""Operator 13 -- hard-negative mining by a secondary-sort shuffle.

Each anchor has its first positives (other rows of its label, best inner product first); a positive opens the window of
scores from 30 % to 90 % of its own, and the first rows of other labels in a window are its hard negatives.

Every (anchor, row) pair that can matter is packed into one binary key -- anchor, descending score, positives before
negatives, id, each as a big-endian number whose sign bit is flipped, so bytes compare like the values.
``repartitionAndSortWithinPartitions`` deals the keys by anchor and sorts them on the way; a streaming iterator then reads each partition once: a
positive opens its window, a negative is emitted to every open window that holds its score and is not yet full.  No
anchor is materialised: the state is one number per open window.

Plan.  Components are quantised by Spark functions and stored.  The anchors (a stated hundredth of the rows) are taken in
passes of at most ``ANCHORS`` rows, whose bounded array is broadcast; each pass scores all rows against it, tile by tile,
twice: once for the positives, once, with the windows known, for the negatives.  A task carries only the best pairs of each anchor and
window over all its tiles (``POSITIVES`` and ``NEGATIVES`` of them, so nothing is lost) and sends them on at its end; so not all
pairs are shuffled, but a few of each anchor and task, whatever the skew of labels or equal vectors.

Scores are exact: a tile is multiplied in double precision where every sum stays below 2^53, in whole numbers else; beyond the range of
a long a score is held to it.

Edge cases: rows with a null id, label or vector, or with a null or non-finite component, take no part; an empty vector scores 0; of
vectors of unequal length the shorter one counts as filled up with zeros; of rows that repeat an id the one with the least
(label, vector) takes part; ties go to the smaller id, also across the equal vectors of a large group; an anchor without positives,
or whose windows hold nothing, has no rows; a positive of negative score has an empty window, one of score 0 takes the rows of score
0; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import release_memory, ship_package
from peerscope.session import materialize

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90                  # percent of the positive's score
ANCHORS = 8192                      # anchors of a pass, at most
TILE_ANCHORS, TILE_ROWS = 256, 4096
SCALE = 256.0
LABELS, SHIFT_EVERY, ANCHOR_EVERY = 10, 7, 100
_LEAST = np.iinfo(np.int64).min
_MOST = np.iinfo(np.int64).max
_SIGN = np.uint64(1 << 63)
KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])


def quantised(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label and q (whole components) of the rows that take part."""
    number = F.col(vec_id).cast("long")
    own = F.col(label).cast("long")
    shifted = F.when(number % SHIFT_EVERY == 0, (own + 1) % LABELS).otherwise(own)
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    q = F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return rows.where(number.isNotNull() & own.isNotNull() & F.col(embedding).isNotNull() & ~bad).select(
        number.alias("vec_id"), shifted.alias("label"), q.alias("q"))


def _distinct(rows: DataFrame) -> DataFrame:
    """One row an id: that with the least (label, vector)."""
    if not rows.groupBy("vec_id").count().where("count > 1").limit(1).count():
        return rows
    return materialize(rows.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select("vec_id", "r.label", "r.q"), "vectors")


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of whole numbers, shorter ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    if sizes.size and (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((sizes.size, width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and ``b``."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not width or not len(a) or not len(b):
        return np.zeros((len(a), len(b)), dtype=np.int64)
    most = width * max(abs(int(a.min())), int(a.max())) * max(abs(int(b.min())), int(b.max()))
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most <= _MOST:
        return a @ b.T
    whole = a.astype(object) @ b.T.astype(object)
    return np.clip(whole, _LEAST + 1, _MOST).astype(np.int64)


def best(s: np.ndarray, valid: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` largest valid scores of each row (-1: none left), ties to the earlier column; in no order."""
    n = s.shape[1]
    out = np.full((len(s), min(k, n)), -1, dtype=np.int64)
    if not n or not len(s):
        return out
    if max(abs(int(s.min())), abs(int(s.max()))) < (1 << 61) // n:
        ranked = np.where(valid, s * n + np.arange(n - 1, -1, -1), _LEAST)
        if k < n:
            at = np.argpartition(ranked, n - k, axis=1)[:, n - k:]
        else:
            at = np.broadcast_to(np.arange(n), s.shape)
        return np.where(np.take_along_axis(valid, at, 1), at, -1)
    for i in range(len(s)):
        own = np.flatnonzero(valid[i])
        own = own[np.argsort(~s[i, own], kind="stable")][:k]       # ~x falls as x rises and cannot overflow
        out[i, :own.size] = own
    return out


def window(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest whole score within LOW to HIGH percent of a positive's; the ends cross for negative ones."""
    p = positive.astype(object)
    return (-((-LOW * p) // 100)).astype(np.int64), (HIGH * p // 100).astype(np.int64)


class Kept:
    """The best pairs of each slot (an anchor, or one of its windows) seen so far."""

    def __init__(self, slots: int, k: int):
        self.score = np.full((slots, k), _LEAST, dtype=np.int64)
        self.id = np.full((slots, k), _MOST, dtype=np.int64)
        self.held = np.zeros((slots, k), dtype=bool)

    def add(self, slots: np.ndarray, s: np.ndarray, ids: np.ndarray, columns: np.ndarray) -> None:
        """Merge each row's ``columns`` (-1: none) of scores ``s``, whose rows are the ``slots``."""
        some = columns >= 0
        score = np.concatenate((self.score[slots], np.where(some, np.take_along_axis(s, np.maximum(columns, 0), 1), _LEAST)), 1)
        own = np.concatenate((self.id[slots], np.where(some, ids[np.maximum(columns, 0)], _MOST)), 1)
        held = np.concatenate((self.held[slots], some), 1)
        order = np.lexsort((own, ~score, ~held), axis=1)[:, :self.score.shape[1]]
        self.score[slots], self.id[slots], self.held[slots] = (np.take_along_axis(x, order, 1) for x in (score, own, held))


def _packed(anchor: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray) -> np.ndarray:
    out = np.empty(len(anchor), dtype=KEY)
    out["anchor"] = anchor.astype(np.int64).view(np.uint64) ^ _SIGN
    out["score"] = ~(score.astype(np.int64).view(np.uint64) ^ _SIGN)
    out["kind"] = kind
    out["id"] = ids.astype(np.int64).view(np.uint64) ^ _SIGN
    return out


def unpack(key: bytes) -> tuple[int, int, int, int]:
    """(anchor, score, kind, id) of a packed pair; kind 0 is a positive, 1 a negative."""
    half = 1 << 63
    return (int.from_bytes(key[:8], "big") - half, (~int.from_bytes(key[8:16], "big") & ((1 << 64) - 1)) - half, key[16],
            int.from_bytes(key[17:25], "big") - half)


def _keys(found: np.ndarray) -> pa.RecordBatch:
    size = KEY.itemsize
    offsets = np.arange(len(found) + 1, dtype=np.int32) * size
    keys = pa.BinaryArray.from_buffers(pa.binary(), len(found), [None, pa.py_buffer(offsets), pa.py_buffer(found.tobytes())])
    return pa.RecordBatch.from_arrays([keys], names=["pair"])


def _tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, components) of at most ``TILE_ROWS`` rows in rising order of id."""
    for batch in batches:
        for start in range(0, batch.num_rows, TILE_ROWS):
            part = batch.slice(start, TILE_ROWS)
            ids = part.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(ids, kind="stable")
            yield ids[order], part.column("label").to_numpy(zero_copy_only=False).astype(np.int64)[order], _matrix(part.column("q"))[order]


def _positive_pairs(rows: DataFrame, anchors, k: int) -> DataFrame:
    """Packed pairs of each anchor with the first ``k`` other rows of its label in each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_ids, a_labels, a_q = anchors.value[:3]
        kept = Kept(len(a_ids), k)
        for ids, labels, q in _tiles(batches):
            for label in np.unique(labels).tolist():
                own, mine = np.flatnonzero(labels == label), np.flatnonzero(a_labels == label)
                for start in range(0, mine.size, TILE_ANCHORS):
                    some = mine[start:start + TILE_ANCHORS]
                    s = scores(a_q[some], q[own])
                    kept.add(some, s, ids[own], best(s, ids[own] != a_ids[some][:, None], k))
        at, place = np.nonzero(kept.held)
        if at.size:
            yield _keys(_packed(a_ids[at], kept.score[at, place], 0, kept.id[at, place]))
        release_memory()

    return rows.mapInArrow(run, "pair binary")


def _negative_pairs(rows: DataFrame, anchors, k: int) -> DataFrame:
    """Packed pairs of each anchor with the first ``k`` rows of other labels in each window, in each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_ids, a_labels, a_q, low, high = anchors.value         # windows: one column a positive
        n_windows = low.shape[1]
        kept = Kept(len(a_ids) * n_windows, k)
        for ids, labels, q in _tiles(batches):
            for start in range(0, len(a_ids), TILE_ANCHORS):
                some = np.arange(start, min(start + TILE_ANCHORS, len(a_ids)))
                s = scores(a_q[some], q)
                other = labels != a_labels[some][:, None]
                for w in range(n_windows):
                    inside = other & (s >= low[some, w][:, None]) & (s <= high[some, w][:, None])
                    any_of = np.flatnonzero(inside.any(1))
                    if any_of.size:
                        kept.add(some[any_of] * n_windows + w, s[any_of], ids, best(s[any_of], inside[any_of], k))
        at, place = np.nonzero(kept.held)
        if at.size:
            yield _keys(np.unique(_packed(a_ids[at // n_windows], kept.score[at, place], 1, kept.id[at, place])))
        release_memory()

    return rows.mapInArrow(run, "pair binary")


def _anchor_of(key: bytes) -> int:
    """Partition number of a packed pair: the anchor's, mixed."""
    x = int.from_bytes(key[:8], "big") * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
    return x >> 33


def _sorted_pairs(pairs: DataFrame):
    """The secondary-sort shuffle: pairs of an anchor in one partition, best score first."""
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.rdd.map(lambda r: (bytes(r[0]), None)).repartitionAndSortWithinPartitions(parts, _anchor_of)


def first_positives(pairs: Iterable[tuple[bytes, None]], k: int) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, number from 0, positive, score) of the first ``k`` positives of each anchor, from sorted pairs."""
    now, seen = None, 0
    for key, _ in pairs:
        anchor, score, _, own = unpack(key)
        if anchor != now:
            now, seen = anchor, 0
        if seen < k:
            yield anchor, seen, own, score
            seen += 1


def mined(pairs: Iterable[tuple[bytes, None]], positives: int, negatives: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(anchor, positive, rank, negative, positive score, negative score) from sorted pairs, in one pass."""
    now, opened = None, []                  # [positive, score, emitted]
    for key, _ in pairs:
        anchor, score, kind, own = unpack(key)
        if anchor != now:
            now, opened, seen = anchor, [], 0
        if kind == 0:
            if seen < positives:
                opened.append([own, score, 0])
                seen += 1
            continue
        for w in opened:
            if w[2] < negatives and LOW * w[1] <= 100 * score <= HIGH * w[1]:
                w[2] += 1
                yield anchor, w[0], w[2], own, w[1], score
        opened = [w for w in opened if w[2] < negatives]


def mine(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", positives: int = POSITIVES,
         negatives: int = NEGATIVES, per_pass: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score."""
    spark = rows.sparkSession
    ship_package(spark)
    table = _distinct(materialize(quantised(rows, vec_id, embedding, label), "vectors"))
    anchor_rows = table.where(F.col("vec_id") % ANCHOR_EVERY == 0)
    passes = max(1, -(-anchor_rows.count() // per_pass))
    while passes > 1:           # dealt by hash, so that a pass may hold somewhat more than its share
        share = F.pmod(F.xxhash64("vec_id"), F.lit(passes))
        if anchor_rows.groupBy(share.alias("p")).count().agg(F.max("count")).first()[0] <= per_pass:
            break
        passes += -(-passes // 8)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    out = []
    for number in range(passes):
        own = anchor_rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == number).toArrow().combine_chunks()   # at most per_pass rows
        if not own.num_rows:
            continue
        ids = own.column("vec_id").to_numpy().astype(np.int64)
        held = [ids, own.column("label").to_numpy().astype(np.int64), _matrix(own.column("q").combine_chunks())]
        shipped = spark.sparkContext.broadcast(held)
        sorted_pairs = _sorted_pairs(_positive_pairs(table, shipped, positives))
        first = materialize(spark.createDataFrame(sorted_pairs.mapPartitions(lambda p: first_positives(p, positives)),
                                                  "anchor_id long, number int, positive_id long, score long"), "positives")
        row_of = {a: i for i, a in enumerate(ids.tolist())}
        low, high = np.full((len(ids), positives), 1, dtype=np.int64), np.zeros((len(ids), positives), dtype=np.int64)
        known = first.collect()                             # at most per_pass times positives
        if known:
            at, place = np.array([row_of[r.anchor_id] for r in known]), np.array([r.number for r in known])
            low[at, place], high[at, place] = window(np.array([r.score for r in known], dtype=np.int64))
        windows = spark.sparkContext.broadcast([*held, low, high])
        opening = first.mapInArrow(_repacked, "pair binary")
        pairs = _sorted_pairs(opening.unionAll(_negative_pairs(table, windows, negatives)))
        found = spark.createDataFrame(pairs.mapPartitions(lambda p: mined(p, positives, negatives)), schema)
        out.append(found if passes == 1 else materialize(found, "negatives"))
    if not out:
        return spark.createDataFrame([], schema)
    result = out[0]
    for more in out[1:]:
        result = result.unionAll(more)
    return result


def _repacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed pairs of the stored positives."""
    for b in batches:
        if b.num_rows:
            yield _keys(_packed(*(b.column(c).to_numpy(zero_copy_only=False) for c in ("anchor_id", "score")), 0,
                                b.column("positive_id").to_numpy(zero_copy_only=False)))


ORACLE_SQL = r"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, s.id AS negative_id, positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
