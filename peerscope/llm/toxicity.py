"""Operator 7 -- toxicity with a classifier chain.

Categories are predicted one after another (Read et al., 2011): the linear model of each category sees the
document's features and the probabilities of the categories before it.  While training, those probabilities
are out-of-fold predictions, so a later model learns from values as unsure as it will get.

Features are the hashed words and the 5- and 6-byte grams (with word boundaries) that occur in the lower-cased
letters of a text, present or not.  Each fit keeps the ``N_FEATURES`` that differ most between the classes
(chi-square) and trains an L1-penalised logistic regression on them by accelerated proximal gradient, so that a few
telling features decide, however long the text.

Training: the features of the sampled documents stay in Spark, which counts the documents of each bucket by class and
fold and finds the features every fit keeps.  A frequent feature is dropped only when it does not separate the classes.
The driver gets the kept columns only, whatever the length of the texts.

The labelled table has one label, ``toxic``.  The categories before it are kinds of toxic documents, found in the labelled
rows themselves, so they hold for any language or vocabulary: the features that tell toxic documents (chi-square in Spark)
are cut into ``KINDS`` groups that occur in the same documents (spherical k-means of their columns, bounded by
``max_train`` x ``N_FEATURES``), and a toxic document is of a kind when it has ``KIND_HITS`` features of that group.  A document may be of
several kinds or of none.  The groups only make the targets of training; scoring uses the models alone.

Scoring: active features and weights (bounded by ``N_FEATURES``) are broadcast; a narrow ``mapInArrow`` scores whole
texts, no shuffle.

Edge cases: null and empty texts have no features and get the models' biases; several labels of one id count as
their maximum, null labels and ids are not learned from, of several texts of one id the one with the smallest features is;
without labels of both classes a category has its smoothed share as probability, and kinds that no telling feature supports have no
members; ties of features go to the smaller bucket; repeated rows are scored each; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import byte_texts, keep_where, map_text
from peerscope.llm.features import LETTERS, Hashed
from peerscope.llm.quality import labelled
from peerscope.session import materialize

BITS = 20
GRAMS = (5, 6)
MAX_TRAIN = 5000
N_FEATURES = 400
PENALTY = 5e-5
ROUNDS = 120
FOLDS = 4
THRESHOLD = 0.2
MIN_DOCS, MIN_CHI = 3, 4      # of a feature that a fit keeps
CHUNK_BYTES = 256 << 10      # of texts whose features a task makes at once, about 40 bytes a byte
FEATURE_BYTES = 1 << 20      # of features that a task counts or cuts at once
KINDS = 2
KIND_CHI = 24       # of a feature that makes a kind: chance gives about one such among 2^BITS buckets
KIND_HITS = 4       # features of a group that make a document one of its kind: a telling word of five letters has so many, with its grams
KIND_ROUNDS = 25
CATEGORIES = (*(f"kind_{k + 1}" for k in range(KINDS)), "toxic")


def _features(h: Hashed) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every occurrence."""
    at, bucket = zip(*(h.grams(n) for n in GRAMS), h.words())
    return h.owners(np.concatenate(at)), np.concatenate(bucket)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class Linear:
    features: np.ndarray        # sorted active buckets
    weights: np.ndarray
    chain: np.ndarray           # weights of the earlier categories
    bias: float


def _fit_linear(doc: np.ndarray, feat: np.ndarray, n: int, y: np.ndarray, earlier: np.ndarray, active: np.ndarray) -> Linear:
    """One category.  ``doc``, ``feat``: features present in each of ``n`` documents; ``active``: the ones to keep, sorted."""
    prior = (y.sum() + 1) / (n + 2)
    bias = float(np.log(prior / (1 - prior)))
    none = np.zeros(0, dtype=np.int64)
    if n == 0 or y.min() == y.max():
        return Linear(none, np.zeros(0), np.zeros(earlier.shape[1]), bias)
    cols = np.searchsorted(active, feat)
    keep = np.append(active, -1)[cols] == feat
    rows, cols = doc[keep], cols[keep]
    m, k = active.size, earlier.shape[1]
    top = 0.25 * (np.bincount(rows, minlength=n).max(initial=0) + k + 1)      # bound of the curvature
    step = n / (top * n) * 4
    x = z = np.zeros(m + k + 1)
    x = x.copy()
    z[-1] = x[-1] = bias
    t, before = 1.0, np.inf

    def loss(w):
        margin = np.bincount(rows, weights=w[:m][cols], minlength=n) + earlier @ w[m:-1] + w[-1]
        return margin, np.logaddexp(0, margin).mean() - (y * margin).mean() + PENALTY * np.abs(w[:m]).sum()

    for _ in range(ROUNDS):
        margin, _ = loss(z)
        g = (_sigmoid(margin) - y) / n
        grad = np.concatenate((np.bincount(cols, weights=g[rows], minlength=m), g @ earlier, [g.sum()]))
        while True:
            new = z - step * grad
            new[:m] = np.sign(new[:m]) * np.maximum(0, np.abs(new[:m]) - step * PENALTY)
            now = loss(new)[1]
            if now <= before + 1e-6 or step < 1e-3:
                break
            step /= 2
            z, t = x, 1.0
            margin, _ = loss(z)
            g = (_sigmoid(margin) - y) / n
            grad = np.concatenate((np.bincount(cols, weights=g[rows], minlength=m), g @ earlier, [g.sum()]))
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / nt * (new - x)
        x, t, before = new, nt, now
        step *= 1.1
    used = np.flatnonzero(x[:m])
    return Linear(active[used].astype(np.int64), x[:m][used], x[m:-1], float(x[-1]))


def _apply(model: Linear, doc: np.ndarray, feat: np.ndarray, n: int, earlier: np.ndarray, bits: int) -> np.ndarray:
    weight = np.zeros(1 << bits)
    weight[model.features] = model.weights
    return _sigmoid(np.bincount(doc, weights=weight[feat], minlength=n) + earlier @ model.chain + model.bias)


@dataclass
class Chain:
    bits: int
    names: tuple[str, ...]
    models: list[Linear] = field(default_factory=list)

    def _prepare(self):
        every = np.unique(np.concatenate([m.features for m in self.models] + [np.zeros(0, dtype=np.int64)]))
        column = np.full(1 << self.bits, -1, dtype=np.int32)
        column[every] = np.arange(every.size)
        weights = np.zeros((every.size, len(self.models)))
        for k, m in enumerate(self.models):
            weights[column[m.features], k] = m.weights
        self._column, self._weights = column, weights

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """(texts x categories)."""
        if not hasattr(self, "_column"):
            self._prepare()
        h = Hashed(texts, LETTERS, self.bits)
        pairs = []
        for at, bucket in (*map(h.grams, GRAMS), h.words()):
            col = self._column[bucket]
            on = np.flatnonzero(col >= 0)
            pairs.append(h.owners(at[on]) * max(1, len(self._weights)) + col[on])
        own = np.unique(np.concatenate(pairs))      # present or not
        doc, col = np.divmod(own, max(1, len(self._weights)))
        out = np.zeros((len(texts), len(self.models)))
        for k, m in enumerate(self.models):
            base = np.bincount(doc, weights=self._weights[col, k], minlength=len(texts)) if col.size else 0.0
            out[:, k] = _sigmoid(base + out[:, :k] @ m.chain + m.bias)
        return out


def train(features: list[np.ndarray], targets: np.ndarray, folds: np.ndarray, active: dict[tuple[int, int | None], np.ndarray],
          names=CATEGORIES, bits: int = BITS) -> Chain:
    """``features``: the kept buckets present in each document; ``targets``: documents x categories (0 or 1);
    ``active``: the buckets of each fit, by category and fold left out (None: of the whole sample)."""
    n = len(features)
    doc = np.repeat(np.arange(n, dtype=np.int32), [f.size for f in features])
    feat = np.concatenate([*features, np.zeros(0, dtype=np.int32)])
    chain = Chain(bits, tuple(names))
    earlier = np.zeros((n, 0))
    for k in range(len(names)):
        y = targets[:, k].astype(float)
        chain.models.append(_fit_linear(doc, feat, n, y, earlier, active[k, None]))
        if k + 1 == len(names):
            break
        out_of_fold = np.zeros(n)
        for f in range(FOLDS):
            test = folds == f
            number = np.cumsum(~test) - 1
            keep = ~test[doc]
            m = _fit_linear(number[doc[keep]], feat[keep], int((~test).sum()), y[~test], earlier[~test], active[k, f])
            number = np.cumsum(test) - 1
            keep = test[doc]
            out_of_fold[test] = _apply(m, number[doc[keep]], feat[keep], int(test.sum()), earlier[test], bits)
        earlier = np.column_stack((earlier, out_of_fold))
    return chain


def _choose(sample: DataFrame, n_categories: int, min_chi: float = MIN_CHI) -> dict[tuple[int, int | None], np.ndarray]:
    """The features each fit keeps, by category and fold left out: most telling first, ties by bucket.

    ``sample`` has ``fold``, ``mask`` (bit k: category k) and ``at``.  Documents are counted by bucket, fold and
    category in Spark; the driver gets the counts of documents and at most ``N_FEATURES`` buckets a fit."""
    def step(chunk: pa.RecordBatch) -> dict:
        at = [np.frombuffer(x, dtype=np.int32) for x in chunk.column("at").to_pylist()]
        code = chunk.column("fold").to_numpy() << n_categories | chunk.column("mask").to_numpy()
        key = np.concatenate(at).astype(np.int64) << 32 | np.repeat(code, [x.size for x in at])
        key, n = np.unique(key, return_counts=True)
        return {"bucket": key >> 32, "code": key & 0xFFFFFFFF, "n": n}

    def sums(n, fold, mask):
        own = {f"d{f}": (fold == f) for f in range(FOLDS)}
        own |= {f"p{k}_{f}": (fold == f) & (mask.bitwiseAND(F.lit(1 << k)) != 0) for k in range(n_categories) for f in range(FOLDS)}
        return [F.coalesce(F.sum(F.when(c, n)), F.lit(0)).alias(name) for name, c in own.items()]

    found = map_text(sample.select("fold", "mask", "at"), step, "bucket int, code int, n long", column="at", max_bytes=FEATURE_BYTES)
    fold, mask = F.shiftright("code", n_categories), F.col("code").bitwiseAND(F.lit((1 << n_categories) - 1))
    counts = found.groupBy("bucket").agg(*sums(F.col("n"), fold, mask))
    counts = materialize(counts.where(sum(F.col(f"d{f}") for f in range(FOLDS)) >= MIN_DOCS), "toxicity_counts")
    docs = sample.agg(*sums(F.lit(1), F.col("fold"), F.col("mask"))).first()
    active = {}
    for k in range(n_categories):
        for out in (None, *(range(FOLDS) if k + 1 < n_categories else ())):
            used = [f for f in range(FOLDS) if f != out]
            n, hits = sum(docs[f"d{f}"] for f in used), sum(docs[f"p{k}_{f}"] for f in used)
            active[k, out] = np.zeros(0, dtype=np.int64)
            if not 0 < hits < n:
                continue
            df, pos = (sum(F.col(f"{x}{f}") for f in used) for x in ("d", f"p{k}_"))
            share = hits / n
            expect = df * share
            chi = (pos - expect) * (pos - expect) / F.greatest(expect * (1 - share) * (1 - df / n), F.lit(1e-9))
            best = counts.where(df >= MIN_DOCS).select("bucket", chi.alias("chi")).where(F.col("chi") > min_chi)
            best = best.orderBy(F.desc("chi"), "bucket").limit(N_FEATURES).collect()
            active[k, out] = np.array(sorted(r["bucket"] for r in best), dtype=np.int64)
    return active


def _kept(sample: DataFrame, kept: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The buckets of ``kept`` in each sampled document, by id, its mask and its fold; at most ``max_train`` rows."""
    kind, kept = sample.schema["doc_id"].dataType.simpleString(), kept.astype(np.int32)

    def cut(chunk: pa.RecordBatch) -> dict:
        at = [np.frombuffer(x, dtype=np.int32) for x in chunk.column("at").to_pylist()]
        return {c: chunk.column(c) for c in ("doc_id", "mask", "fold")} | {"at": [x[np.isin(x, kept)].tobytes() for x in at]}

    few = map_text(sample, cut, f"doc_id {kind}, mask int, fold int, at binary", column="at", max_bytes=FEATURE_BYTES)
    own = sorted(few.collect(), key=lambda r: r["doc_id"])
    return ([np.frombuffer(bytes(r["at"]), dtype=np.int32) for r in own], np.array([r["mask"] for r in own], dtype=np.int64),
            np.array([r["fold"] for r in own], dtype=np.int64))


def _groups(features: list[np.ndarray], toxic: np.ndarray, telling: np.ndarray, k: int = KINDS) -> list[np.ndarray]:
    """``telling`` buckets that are more frequent in toxic documents, in ``k`` groups that occur in the same ones; groups without
    a feature are empty.  The first centre is the feature of most toxic documents, each next
    one that of most toxic documents, weighed by how little it is like those before."""
    has = np.zeros((len(features), telling.size), dtype=np.float32)
    for row, f in zip(has, features):
        row[np.searchsorted(telling, f)] = 1
    seen, hits = has.sum(0), has[toxic > 0].sum(0)
    own = np.flatnonzero(hits * len(features) > seen * (toxic > 0).sum())
    columns = has[toxic > 0][:, own].T
    if not own.size:
        return [np.zeros(0, dtype=np.int32)] * k
    columns /= np.sqrt(columns.sum(1, keepdims=True))
    centres = columns[[int(hits[own].argmax())]]
    while len(centres) < min(k, own.size):
        apart = 1 - (columns @ centres.T).max(1)
        centres = np.vstack((centres, columns[int((hits[own] * apart).argmax())]))
    group = np.full(own.size, -1)
    for _ in range(KIND_ROUNDS):
        after = (columns @ centres.T).argmax(1)
        if (after == group).all():
            break
        group = after
        sums = np.stack([columns[group == c].sum(0) for c in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return [telling[own[group == c]].astype(np.int32) for c in range(k)]


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", max_train: int = MAX_TRAIN, doc_id: str = "doc_id",
        text: str = "text", bits: int = BITS) -> Chain:
    """Learns from at most ``max_train`` labelled documents; tasks reduce the texts to features, of which the driver
    gets the ones that a fit keeps."""
    rows = labelled(docs, labels, target, max_train, doc_id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def step(chunk: pa.RecordBatch) -> dict:
        at = [np.unique(_features(Hashed([t], LETTERS, bits))[1]).astype(np.int32).tobytes() for t in byte_texts(chunk)]
        return {"doc_id": chunk.column("doc_id"), "mask": [int(y > 0) for y in chunk.column("label").to_pylist()], "at": at}

    got = map_text(rows, step, f"doc_id {kind}, mask int, at binary", max_bytes=CHUNK_BYTES)
    one = got.groupBy("doc_id").agg(F.min(F.struct("mask", "at")).alias("x")).select(
        "doc_id", "x.*", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold"))
    sample = materialize(one, "toxicity_sample")
    telling = _choose(sample, 1, KIND_CHI)[0, None]
    groups = _groups(*_kept(sample, telling)[:2], telling)

    def mark(chunk: pa.RecordBatch) -> dict:
        at = [np.frombuffer(x, dtype=np.int32) for x in chunk.column("at").to_pylist()]
        mask = [sum(int(np.isin(g, x).sum() >= KIND_HITS) << k for k, g in enumerate(groups)) | 1 << KINDS if y else 0
                for x, y in zip(at, chunk.column("mask").to_pylist())]
        return {c: chunk.column(c) for c in ("doc_id", "fold", "at")} | {"mask": mask}

    # stored: each step that follows would else be a second Python worker beside this one, in every core, and mark again
    marked = map_text(sample, mark, f"doc_id {kind}, mask int, at binary, fold int", column="at", max_bytes=FEATURE_BYTES)
    marked = materialize(marked, "toxicity_marked")
    active = _choose(marked, len(CATEGORIES))
    features, mask, folds = _kept(marked, np.unique(np.concatenate(list(active.values()))))
    targets = mask[:, None] >> np.arange(len(CATEGORIES)) & 1
    return train(features, targets, folds, active, bits=bits)


def score(docs: DataFrame, chain: Chain, doc_id: str = "doc_id", text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs``: doc_id, a probability for each category, is_toxic (the last one reaches the threshold)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{c}" for c in chain.names]

    def step(chunk: pa.RecordBatch) -> dict:
        p = held.value.probabilities(byte_texts(chunk))
        return {"doc_id": chunk.column("doc_id"), "is_toxic": p[:, -1] >= threshold, **{c: p[:, k] for k, c in enumerate(names)}}

    schema = f"doc_id {kind}, " + ", ".join(f"{c} double" for c in names) + ", is_toxic boolean"
    return map_text(rows, step, schema, max_bytes=CHUNK_BYTES)


def reject(docs: DataFrame, chain: Chain, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that ``score`` calls toxic, all columns."""
    held = docs.sparkSession.sparkContext.broadcast(chain)
    return keep_where(docs, lambda chunk: held.value.probabilities(byte_texts(chunk, text))[:, -1] < threshold, text, CHUNK_BYTES)
