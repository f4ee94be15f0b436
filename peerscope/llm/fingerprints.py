"""Operator 4 -- document fingerprints as a homomorphic multiset hash.

A fingerprint is a sum over a text's paragraphs (lines) of wide vectors hashed from them, so paragraphs may be
added and removed one by one and their order does not matter:

* eight lanes modulo 2^64 hold the sum of each paragraph's BLAKE2b digest; equal multisets of paragraphs have
  equal sums, different ones collide with negligible probability;
* ``LANES`` lanes modulo 2^32 hold the sum of each paragraph's signed gram counts: every run of eight bytes in the
  paragraph (or the whole of a shorter one) adds +1 or -1 to one lane.  The inner product of two such vectors
  estimates the grams in common, so their cosine, not below 0, is the likeness of two fingerprints.  Texts have less
  than 2^31 bytes, so the sums of a text never wrap.

``edited`` texts need the next document in falling order of id.  Ids are cut into ranges at quantiles of a bounded
sample (only balance depends on it); the first row of each range is also sent to the range before it, so each
task streams its sorted range and always has the next row.  Texts are shuffled once.  No window over the table.

Edge cases: null texts are empty, an empty text has the zero fingerprint, two empty texts have likeness 1 and an
empty and another text 0; of repeated ids the rows follow each other by text; null ids come
last; a single document is its own next one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import map_text, ship_package, text_chunks

LANES = 256
_EXACT = 8
_K = np.uint64(0x9E3779B97F4A7C15)
ROWS_PER_RANGE = 4096
MAX_RANGES = 20_000
SAMPLE_PER_RANGE = 40
CHUNK_BYTES = 1 << 20


def vectors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(texts x 8 uint64, texts x LANES int32): the two parts of each text's fingerprint."""
    exact = np.zeros((len(texts), _EXACT), dtype=np.uint64)
    for k, t in enumerate(texts):
        if t:
            own = b"".join([hashlib.blake2b(p).digest() for p in t.split(b"\n")])
            exact[k] = np.frombuffer(own, dtype="<u8").reshape(-1, _EXACT).sum(axis=0, dtype=np.uint64)
    buf = np.frombuffer(b"\n".join(texts) + b"\n" + b"\0" * 8, dtype=np.uint8)
    size = buf.size - 8
    ends = np.flatnonzero(buf[:size] == 10)
    starts = np.append(0, ends[:-1] + 1)
    lens = ends - starts
    words = np.ndarray((size,), dtype="<u8", buffer=buf.data, strides=(1,))
    # runs of eight bytes inside one paragraph
    inside = np.zeros(size + 1, dtype=np.int8)
    long = lens >= 8
    inside[starts[long]] += 1
    inside[ends[long] - 7] -= 1
    at = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    short = np.flatnonzero((lens > 0) & (lens < 8))
    value = np.concatenate((words[at], words[starts[short]] & ((np.uint64(1) << (8 * lens[short]).astype(np.uint64)) - np.uint64(1))))
    where = np.concatenate((at, starts[short]))
    value *= _K
    value ^= value >> np.uint64(32)
    value *= _K
    lane = (value >> np.uint64(56)).astype(np.int64) % LANES
    sign = ((value >> np.uint64(40)) & np.uint64(1)).astype(np.int64) * 2 - 1
    bounds = np.cumsum([len(t) + 1 for t in texts])
    owner = np.searchsorted(bounds, where, side="right")
    total = np.bincount(owner * LANES + lane, weights=sign, minlength=len(texts) * LANES).astype(np.int64)
    return exact, total.astype(np.int32).reshape(len(texts), LANES)       # modulo 2^32


def encode(exact: np.ndarray, lanes: np.ndarray) -> list[str]:
    return [base64.b64encode(a.astype("<u8").tobytes() + b.astype("<i4").tobytes()).decode() for a, b in zip(exact, lanes)]


def decode(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = base64.b64decode(fingerprint)
    return np.frombuffer(raw[:8 * _EXACT], dtype="<u8"), np.frombuffer(raw[8 * _EXACT:], dtype="<i4")


def fingerprint(text: bytes) -> str:
    return encode(*vectors([text]))[0]


def combine(left: str, right: str, remove: bool = False) -> str:
    """Fingerprint after inserting (or deleting) the paragraphs behind ``right``; no text is read."""
    (a, b), (c, d) = decode(left), decode(right)
    return encode(*((x - y if remove else x + y)[None] for x, y in ((a, c), (b, d))))[0]


def likeness(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Row by row, 0 to 1."""
    a, b = left[1].astype(np.float64), right[1].astype(np.float64)
    na, nb = (a * a).sum(1), (b * b).sum(1)
    cos = (a * b).sum(1) / np.sqrt(np.maximum(na * nb, 1e-300))
    same = (left[0] == right[0]).all(1) & (left[1] == right[1]).all(1)
    return np.where(same, 1.0, np.where((na == 0) | (nb == 0), 0.0, np.clip(cos, 0, 1)))


def _ranges(docs: DataFrame, rows_per_range: int) -> tuple[np.ndarray, dict[int, int], dict[int, int | None]]:
    """Split points; by range, the one that needs its first row as a tail, and its first (largest) id.
    The driver gets a sample of at most about SAMPLE_PER_RANGE ids a range and one row a range."""
    ids = docs.select("doc_id")
    n = ids.count()
    want = int(min(MAX_RANGES, max(1, -(-n // rows_per_range))))
    known = ids.where(F.col("doc_id").isNotNull())
    part = min(1.0, SAMPLE_PER_RANGE * want / max(1, n))
    sample = np.sort(known.sample(False, part, 11).toPandas()["doc_id"].to_numpy(dtype=np.int64))
    splits = np.unique(sample[np.arange(1, want) * sample.size // want]) if sample.size and want > 1 else np.zeros(0, dtype=np.int64)

    def first(batches):
        for b in batches:
            own, missing = _range_of(b.column("doc_id"), splits)
            values = b.column("doc_id").fill_null(0).to_numpy()
            out = {k: int(values[own == k].max()) for k in np.unique(own[~missing]).tolist()}
            if missing.any():
                out[-1] = None
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int32()), pa.array(list(out.values()), pa.int64())], names=["range", "top"])

    tops = {r["range"]: r["top"] for r in ids.mapInArrow(first, "range int, top long").groupBy("range").agg(F.max("top").alias("top")).collect()}
    order = sorted(tops, reverse=True)
    before = {r: order[k - 1] for k, r in enumerate(order)}      # the first range follows the last one
    return splits, before, tops


def _range_of(ids: pa.Array, splits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    missing = ids.is_null().to_numpy(zero_copy_only=False)
    own = np.searchsorted(splits, ids.fill_null(0).to_numpy(), side="right")
    return np.where(missing, -1, own), missing


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per row of ``docs``, with the columns of ``SCHEMA``; integer ids."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    splits, before, tops = _ranges(rows, rows_per_range)

    def deal(chunk: pa.RecordBatch) -> dict:
        own, missing = _range_of(chunk.column("doc_id"), splits)
        values = chunk.column("doc_id").fill_null(0).to_numpy()
        first = np.fromiter(((tops[k] is None) if m else tops[k] == v for k, v, m in zip(own.tolist(), values.tolist(), missing.tolist())),
                            dtype=bool, count=own.size)
        tails = np.flatnonzero(first)
        take = pa.array(np.concatenate((np.arange(own.size), tails)))
        return {"range": np.concatenate((own, [before[k] for k in own[tails].tolist()])).astype(np.int32),
                "tail": np.concatenate((np.zeros(own.size, bool), np.ones(tails.size, bool))),
                "doc_id": chunk.column("doc_id").take(take), "text": chunk.column("text").take(take)}

    dealt = map_text(rows, deal, "range int, tail boolean, doc_id long, text string")
    ordered = dealt.repartition("range").sortWithinPartitions("range", "tail", F.col("doc_id").desc_nulls_last(), "text")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for chunk in text_chunks(batches, "text", CHUNK_BYTES):
            held += zip(*(chunk.column(c).to_pylist() for c in ("range", "tail", "doc_id", "text")))
            if len(held) > 1:
                yield _chain(held)
                held = held[-1:]

    return ordered.mapInArrow(stream, SCHEMA)


def _chain(rows: list[tuple]) -> pa.RecordBatch:
    """Results of all rows but tails and the last one; a row's next one is the row after it."""
    texts = [r[3] or "" for r in rows]
    own = vectors([t.encode() for t in texts])
    at = [k for k in range(len(rows) - 1) if not rows[k][1]]
    edited = []
    for k in at:
        n = len(texts[k]) // 2
        edited.append((texts[k][:len(texts[k]) - n] + texts[k + 1][:n]).encode())
    new = vectors(edited) if at else (np.zeros((0, _EXACT), np.uint64), np.zeros((0, LANES), np.int16))
    here = tuple(x[at] for x in own)
    after = tuple(x[[k + 1 for k in at]] for x in own)
    cols = [[rows[k][2] for k in at], [len(texts[k]) for k in at], [hashlib.sha256(e).hexdigest() for e in edited],
            encode(*here), encode(*new), likeness(here, new), likeness(here, after)]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(cols, kinds)],
                                      names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
