"""Operator 8 -- best-fit packing by non-negative least squares over length patterns.

1. Documents become token ids plus an end id.  Longer ones than a sequence are cut into full pieces, the
   first piece may be shorter.
2. Patterns are the full piece, all pairs and all triples of lengths that fill a sequence exactly.  How often
   each is used is a non-negative least squares fit of the pattern counts to the histogram of piece lengths
   (accelerated projected gradient).  The counts are rounded, largest first, within what the histogram has.
3. What the rounded patterns leave is packed by best fit in falling order of length, on counts, so that one
   step places many equal pieces.
4. The plan says for each length which ranks go to which sequences.  A piece's rank among those of its
   length is its place within its partition plus an offset by partition, so no length is gathered anywhere.

Plan: one pass over the texts writes the pieces' lengths and checksums to the checkpoint folder; the
histogram (at most ``size`` rows) goes to the driver, the plan (bounded by the patterns, not by the rows) is
broadcast; ranks need one small shuffle of (partition, length) counts.

Edge cases: null and empty texts are the end id alone; repeated rows are packed each; ties between equal
lengths go by partition and place; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerscope.llm.common import map_text, release_memory, small_batches
from peerscope.llm.pieces import Pretokens, WordTable, class_table, segments
from peerscope.session import materialize

SIZE = 1024
END_ID = 2
CHUNK_BYTES = 1 << 19
CACHE_BITS = 22
WORDS_AT_ONCE = 4096        # the library's result for a word takes about 1 kB until its ids are read
FIT_ROUNDS = 150
SHARES = (1.0, 0.9, 0.75, 0.5, 0.25)


class Encoder:
    """Token ids (little-endian unsigned 32-bit) of texts by the ``tokenizers`` library, each distinct word once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        """Ids of the words seen before: word ``k`` has ``store[begin[k]:][:lens[k]]``."""
        self.words = WordTable(CACHE_BITS)
        self.store = np.zeros(0, dtype="<u4")
        self.begin = self.lens = np.zeros(0, dtype=np.int64)

    def encode(self, texts: list[str], table: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        parts: list[str] = []
        owner: list[int] = []
        for k, t in enumerate(texts):
            if any(s in t for s in self.special):
                out[k] = np.array(self.lib.encode(t, add_special_tokens=False).ids, dtype="<u4")
                t = ""
            own = segments(t)
            parts += own
            owner += [k] * len(own)
        flat, ends = self._ids(parts, np.array(owner), len(texts), table)
        starts = np.append(0, ends[:-1])
        return [flat[a:b] if o is None else o for o, a, b in zip(out, starts.tolist(), ends.tolist())]

    def _ids(self, parts, owner, n_texts, table):
        cut = Pretokens(parts, table)
        if not cut.starts.size:
            return np.zeros(0, dtype="<u4"), np.zeros(n_texts, dtype=np.int64)
        number = self.words.find(cut.hashes)
        missing = np.flatnonzero(number < 0)
        if missing.size:
            if self.words.full():
                self._forget()
                number = np.full(cut.hashes.size, -1, dtype=np.int32)
                missing = np.arange(cut.hashes.size)
            new, first, which = np.unique(cut.hashes[missing], return_index=True, return_inverse=True)
            got = []
            for k in range(0, new.size, WORDS_AT_ONCE):
                some = [cut.word(w) for w in missing[first[k:k + WORDS_AT_ONCE]].tolist()]
                got += [np.array(e.ids, dtype="<u4") for e in self.lib.encode_batch_fast(some, add_special_tokens=False)]
            fresh = np.arange(new.size, dtype=np.int32) + self.lens.size
            self.words.add(new, fresh)
            number[missing] = fresh[which]
            lens = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
            self.begin = np.append(self.begin, self.store.size + np.cumsum(lens) - lens)
            self.lens = np.append(self.lens, lens)
            self.store = np.concatenate([self.store, *got])
        n = self.lens[number]
        ends = np.cumsum(n)
        flat = self.store[np.arange(ends[-1]) + np.repeat(self.begin[number] - (ends - n), n)]
        per_text = np.bincount(owner[cut.owner], weights=n, minlength=n_texts).astype(np.int64)
        return flat, np.cumsum(per_text)


def cut_points(n: int, size: int) -> list[int]:
    """Starts of the pieces of a document of ``n`` ids, with its end: only the first may be shorter."""
    head = n % size or size
    return [0, *range(head, n + 1, size)] if n > size else [0, n]


def token_pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", size: int = SIZE,
                 end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids, binary), with the partition and the
    piece's rank among those of its length there."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    table = docs.sparkSession.sparkContext.broadcast(class_table())
    tail = np.array([end_id], dtype="<u4").tobytes()

    def setup():
        encoder = Encoder(path)
        release_memory()        # what reading the vocabulary file took
        return encoder, np.zeros(size + 1, dtype=np.int64)

    def step(chunk: pa.RecordBatch, state) -> dict:
        encoder, seen = state
        part = TaskContext.get().partitionId()
        out: dict[str, list] = defaultdict(list)
        at = []
        texts = [t or "" for t in chunk.column("text").to_pylist()]
        for k, ids in enumerate(encoder.encode(texts, table.value)):
            raw = ids.tobytes() + tail
            points = cut_points(len(raw) // 4, size)
            for j, (a, b) in enumerate(zip(points, points[1:])):
                at.append(k)
                out["piece"].append(j)
                out["start"].append(a)
                out["length"].append(b - a)
                out["ids_crc32"].append(zlib.crc32(raw[4 * a:4 * b]))
                out["place"].append(int(seen[b - a]))
                seen[b - a] += 1
                if keep_ids:
                    out["ids"].append(raw[4 * a:4 * b])
        out["doc_id"] = chunk.column("doc_id").take(pa.array(at, type=pa.int64()))
        out["part"] = [part] * len(at)
        return out

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, place long"
    return map_text(rows, step, schema + ", ids binary" * keep_ids, setup=setup, max_bytes=CHUNK_BYTES)


def patterns(size: int) -> np.ndarray:
    """Rows of up to three lengths (0: none) that fill a sequence exactly, longest first."""
    a, b = np.meshgrid(np.arange(1, size), np.arange(1, size), indexing="ij")
    c = size - a - b
    ok = (c >= 1) & (a >= b) & (b >= c)
    pairs = np.arange((size + 1) // 2, size)
    return np.concatenate([[[size, 0, 0]], np.stack([pairs, size - pairs, 0 * pairs], 1),
                           np.stack([a[ok], b[ok], c[ok]], 1)]).astype(np.int64)


def fit_counts(rows: np.ndarray, hist: np.ndarray, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """x >= 0 with the pattern counts' sum close to ``hist`` (least squares, accelerated projected gradient)."""
    def forward(x):
        y = np.bincount(rows.ravel(), weights=np.repeat(x, rows.shape[1]), minlength=hist.size)
        y[0] = 0
        return y

    target = hist.astype(float)
    target[0] = 0
    v = np.ones(len(rows))
    for _ in range(12):         # largest eigenvalue of the normal matrix
        w = forward(v)[rows].sum(1)
        top = np.linalg.norm(w)
        v = w / top
    x = z = np.zeros(len(rows))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, z - (forward(z) - target)[rows].sum(1) / top)
        step = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, x, t = new + (t - 1) / step * (new - x), new, step
    return x


def make_plan(hist: np.ndarray, size: int = SIZE) -> dict[str, np.ndarray]:
    """Runs of equal pieces: (length, first rank, first sequence, offset), sorted by length and rank.
    Piece number r of a length, in run i, goes to sequence ``seq[i] + r - rank[i]``.

    Rounded patterns can use up the short pieces that the residual would need to fill its gaps, so smaller
    shares of the fitted counts are tried as well and the plan with the fewest sequences is taken."""
    left = hist.astype(np.int64).copy()
    rows = patterns(size)
    rows = rows[(left[rows] > 0)[:, 0] & ((rows[:, 1] == 0) | (left[rows[:, 1]] > 0)) & ((rows[:, 2] == 0) | (left[rows[:, 2]] > 0))]
    bins: list[tuple[tuple[int, ...], int]] = []        # (lengths, how many such sequences)
    if left[size]:
        bins.append(((size,), int(left[size])))
        left[size] = 0
    rows = rows[rows[:, 0] != size]
    if len(rows):
        x = fit_counts(rows, left)
        tried = [_fill(rows, share * x, left, size) for share in SHARES]
        bins += min(tried, key=lambda own: sum(n for _, n in own))
    else:
        bins += _best_fit(left, size)
    return _runs(bins, size)


def _fill(rows: np.ndarray, x: np.ndarray, left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Rounded patterns, largest count first, then best fit for what they leave."""
    left, bins = left.copy(), []
    order = np.argsort(-x, kind="stable")
    for k in order[x[order] >= 0.5].tolist():
        own = [int(v) for v in rows[k] if v]
        want = min([int(x[k] + 0.5), *(int(left[v]) // own.count(v) for v in own)])
        if want > 0:
            for v in own:
                left[v] -= want
            bins.append((tuple(own), want))
    return bins + _best_fit(left, size)


def _best_fit(left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    left = left.copy()
    # best fit in falling order, many equal pieces at a time; gaps[g]: sequences with g free
    gaps: dict[int, list[list]] = defaultdict(list)
    for length in range(size, 0, -1):
        n = int(left[length])
        while n:
            gap = next((g for g in range(length, size) if gaps.get(g)), None)
            if gap is None:
                each = size // length
                whole, rest = divmod(n, each)
                if whole:
                    gaps[size - each * length].append([(length,) * each, whole])
                if rest:
                    gaps[size - rest * length].append([(length,) * rest, 1])
                break
            own, count = gaps[gap][-1]
            take = min(n, count)
            if take == count:
                gaps[gap].pop()
            else:
                gaps[gap][-1][1] -= take
            gaps[gap - length].append([(*own, length), take])
            n -= take
    return [(own, count) for held in gaps.values() for own, count in held]


def _runs(bins: list[tuple[tuple[int, ...], int]], size: int) -> dict[str, np.ndarray]:
    runs, used, seq = [], np.zeros(size + 1, dtype=np.int64), 0
    for own, count in bins:
        offset = 0
        for v in own:
            runs.append((v, int(used[v]), seq, offset))
            used[v] += count
            offset += v
        seq += count
    runs.sort()
    table = np.array(runs, dtype=np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "rank": table[:, 1], "seq": table[:, 2], "offset": table[:, 3], "sequences": np.int64(seq)}


def place(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Adds sequence_id and offset to stored ``token_pieces``."""
    per_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    hist = np.zeros(size + 1, dtype=np.int64)
    for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect():    # at most `size` rows
        hist[r["length"]] = r["n"]
    plan = pieces.sparkSession.sparkContext.broadcast(make_plan(hist, size))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.col("base") + F.col("place"))
    out = ranked.drop("part", "place", "base")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema.fields if f.name != "rank")

    def assign(batches):
        p = plan.value
        keys = p["length"] * (1 << 44) + p["rank"]
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            run = np.searchsorted(keys, length * (1 << 44) + rank, side="right") - 1
            cols = [b.column(n) for n in b.schema.names if n != "rank"]
            names = [n for n in b.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(p["seq"][run] + rank - p["rank"][run]), pa.array(p["offset"][run])],
                names=[*names, "sequence_id", "offset"])

    return out.mapInArrow(assign, fields + ", sequence_id long, offset long")


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", size: int = SIZE,
         end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    with small_batches(docs.sparkSession):
        pieces = materialize(token_pieces(docs, path, doc_id, text, size, end_id, keep_ids), "pieces")
    placed = place(pieces, size)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
                         *["ids"] * keep_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences' ids (``pack(keep_ids=True)``); a group holds at most one sequence of ids."""
    one = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("own"))
    joined = F.aggregate("own", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return one.select("sequence_id", joined.alias("ids"))
