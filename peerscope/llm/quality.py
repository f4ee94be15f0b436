"""Operator 9 -- quality classifier with supervised subword embeddings.

Every hashed word and character n-gram has a learned vector; a document is the weighted mean of its features'
vectors, and a softmax layer gives the class probabilities (after Joulin et al., 2016).  A word that
repeats the one before it also counts as one fixed feature.  Vectors and softmax weights are
trained together by numpy stochastic gradient descent on at most ``MAX_TRAIN`` labelled documents of at most
``MAX_TRAIN_BYTES`` of features, taken in the order of a hash of their id: the features stay in Spark, which sums their
sizes in that order, and the driver gets the rows before the bound only, whatever the length of the texts.

Scoring: the mean and the softmax layer are linear, so with two classes each feature's vector
folds into one number.  The table of these numbers (2^BITS floats, fixed size) is broadcast and texts are
scored in a narrow ``mapInArrow``; no shuffle, whole texts.

Edge cases: null and empty texts have no features and get the softmax bias alone; repeated rows are scored
each; several labels of one id count as their maximum, of several texts of one id the one with the smallest features is learned from, null labels and ids are not learned from; without
labels of both classes the score is the smoothed share of class 1; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import bounded_sample, byte_texts, crc_mod4, keep_where, map_text
from peerscope.llm.features import KEEP_ALL, Hashed
from peerscope.session import materialize

BITS = 17
GRAMS = (3, 4, 5)
WORD_WEIGHT, REPEAT_WEIGHT = 4.0, 16.0
MAX_TRAIN = 1500
MAX_TRAIN_BYTES = 256 << 20     # of the features of the sample, 8 bytes a bucket of a document
DIM, EPOCHS, RATE, BATCH, SEED = 8, 10, 8.0, 32, 7
THRESHOLD = 0.7
REJECT_BELOW = 0.5
HELD_OUT = 2
CHUNK_BYTES = 256 << 10      # of texts whose features a task makes at once, about 40 bytes a byte
REPEAT = 0      # bucket of the repetition feature


def feature_sets(texts: list[bytes], bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, weights) of each text, weights adding up to 1; used for training."""
    out = []
    for t in texts:
        h = Hashed([t], KEEP_ALL, bits)
        w = np.zeros(1 << bits, dtype=np.float32)
        for n in GRAMS:
            w += np.bincount(h.grams(n)[1], minlength=w.size)
        w += WORD_WEIGHT * np.bincount(h.words()[1], minlength=w.size)
        w[REPEAT] += REPEAT_WEIGHT * h.repeats().size
        at = np.flatnonzero(w)
        out.append((at.astype(np.int32), w[at] / max(1.0, w.sum(dtype=np.float64))))
    return out


@dataclass
class Model:
    table: np.ndarray       # float32, one number a feature: its vector times (weights of class 1 - of class 0)
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        h = Hashed(texts, KEEP_ALL, int(self.table.size).bit_length() - 1)
        total = np.zeros(len(texts))
        weight = np.zeros(len(texts))
        for n in GRAMS:
            at, bucket = h.grams(n)
            total += h.sums(at, self.table[bucket])
            weight += h.counts(at)
        at, bucket = h.words()
        total += WORD_WEIGHT * h.sums(at, self.table[bucket])
        weight += WORD_WEIGHT * h.counts(at)
        n = h.counts(h.repeats())
        total += REPEAT_WEIGHT * self.table[REPEAT] * n
        weight += REPEAT_WEIGHT * n
        z = self.bias + total / np.maximum(1.0, weight)
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int = BITS, dim: int = DIM,
          epochs: int = EPOCHS, rate: float = RATE, batch: int = BATCH, seed: int = SEED) -> Model:
    """Stochastic gradient descent on vectors and softmax weights, falling rate."""
    y = np.asarray(labels, dtype=np.int64)
    share = (y.sum() + 1) / (y.size + 2)
    prior = float(np.log(share / (1 - share)))
    if y.size == 0 or y.min() == y.max():
        return Model(np.zeros(1 << bits, dtype=np.float32), prior)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (1 << bits, dim)).astype(np.float32) / dim
    weights = rng.uniform(-1, 1, (dim, 2)).astype(np.float32)
    bias = np.array([0.0, prior], dtype=np.float32)
    steps = epochs * -(-y.size // batch)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(y.size)
        for start in range(0, y.size, batch):
            lr = rate * (1 - step / steps)
            step += 1
            pick = order[start:start + batch]
            idx = np.concatenate([rows[k][0] for k in pick])
            val = np.concatenate([rows[k][1] for k in pick]).astype(np.float32)
            lens = np.array([rows[k][0].size for k in pick])
            mean = np.zeros((pick.size, dim), dtype=np.float32)
            full = np.flatnonzero(lens)
            if full.size:
                begin = np.append(0, np.cumsum(lens[full])[:-1])
                mean[full] = np.add.reduceat(val[:, None] * vectors[idx], begin, axis=0)
            z = mean @ weights + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(pick.size), y[pick]] -= 1
            p /= pick.size
            back = np.repeat(p @ weights.T, lens, axis=0) * val[:, None]
            weights -= 0.1 * lr * (mean.T @ p)
            bias -= 0.01 * lr * p.sum(0)
            uniq, inv = np.unique(idx, return_inverse=True)
            for j in range(dim):
                vectors[uniq, j] -= lr * pick.size * np.bincount(inv, weights=back[:, j]).astype(np.float32)
    fold = (vectors @ (weights[:, 1] - weights[:, 0])).astype(np.float32)
    return Model(fold, float(bias[1] - bias[0]))


def labelled(docs: DataFrame, labels: DataFrame, target: str, max_train: int, doc_id: str, text: str,
             condition=None) -> DataFrame:
    """At most ``max_train`` ids with their label (order: a hash of the id) and texts; the ids are few enough
    to broadcast by that bound."""
    rows = labels.where(F.col(target).isNotNull() & F.col(doc_id).isNotNull())
    if condition is not None:
        rows = rows.where(condition)
    one = rows.groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(F.col(target)).cast("int").alias("label"))
    few = bounded_sample(one, max_train, "doc_id")
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(few), "doc_id")


def within_bytes(sample: DataFrame, max_bytes: int) -> DataFrame:
    """The rows of ``sample`` (few, see ``labelled``) whose features, summed in the order of a hash of the id, stay within
    ``max_bytes``; a stored frame is expected.  The driver gets the sizes only."""
    sizes = sample.select("doc_id", (F.length("at") + F.length("weight")).alias("size"), F.xxhash64("doc_id").alias("h")).toPandas()
    sizes = sizes.sort_values(["h", "doc_id"], ignore_index=True)
    if sizes["size"].sum() <= max_bytes:
        return sample
    last = int(np.searchsorted(sizes["size"].cumsum().to_numpy(), max_bytes, side="right"))
    if last == 0:
        return sample.limit(0)
    end = sizes.iloc[last - 1]
    h = F.xxhash64("doc_id")
    return sample.where((h < F.lit(int(end["h"]))) | (h == F.lit(int(end["h"]))) & (F.col("doc_id") <= F.lit(end["doc_id"].item() if hasattr(end["doc_id"], "item") else end["doc_id"])))


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", max_train: int = MAX_TRAIN,
        doc_id: str = "doc_id", text: str = "text", bits: int = BITS, max_bytes: int = MAX_TRAIN_BYTES) -> Model:
    """Learns from the labelled rows outside the held-out fold.  Tasks turn the texts into feature counts; the
    driver gets ``max_train`` of them at most, and at most ``max_bytes``."""
    rows = labelled(docs, labels, target, max_train, doc_id, text, crc_mod4(doc_id) != HELD_OUT)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def step(chunk: pa.RecordBatch) -> dict:
        sets = feature_sets(byte_texts(chunk), bits)
        return {"doc_id": chunk.column("doc_id"), "label": chunk.column("label"),
                "at": [a.tobytes() for a, _ in sets], "weight": [w.astype(np.float32).tobytes() for _, w in sets]}

    got = map_text(rows, step, f"doc_id {kind}, label int, at binary, weight binary", max_bytes=CHUNK_BYTES)
    one = got.groupBy("doc_id").agg(F.min(F.struct("label", "at", "weight")).alias("x")).select("doc_id", "x.*")
    few = within_bytes(materialize(one, "quality_sample"), max_bytes)
    own = sorted(few.collect(), key=lambda r: r["doc_id"])
    sets = [(np.frombuffer(bytes(r["at"]), dtype=np.int32), np.frombuffer(bytes(r["weight"]), dtype=np.float32)) for r in own]
    y = np.array([r["label"] for r in own])
    del own
    return train(sets, y, bits)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs``: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(model)

    def step(chunk: pa.RecordBatch) -> dict:
        s = held.value.score(byte_texts(chunk))
        return {"doc_id": chunk.column("doc_id"), "score": s, "predicted": (s >= threshold).astype(np.int32)}

    out = map_text(rows, step, f"doc_id {kind}, score double, predicted int", max_bytes=CHUNK_BYTES)
    return out.select("doc_id", F.coalesce(crc_mod4("doc_id") == HELD_OUT, F.lit(False)).alias("held_out"), "score", "predicted")


def reject(docs: DataFrame, model: Model, text: str = "text", below: float = REJECT_BELOW) -> DataFrame:
    """``docs`` without the rows whose score is below ``below``, all columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return keep_where(docs, lambda chunk: held.value.score(byte_texts(chunk, text)) >= below, text, CHUNK_BYTES)
