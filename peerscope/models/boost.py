"""Supervised scorer: histogram gradient boosting with out-of-fold probabilities.

The published supervised score of a provider is the probability from the model trained on the *other* folds (stratified, hash-assigned
folds).  Each training set is oversampled with SMOTE (training rows only) and positives carry the weight ``n0 / n1`` of the
full data.  The final model is refit on all rows (also oversampled) and kept for scoring and attribution.

All models -- one a fold, and the refit, number 0 -- are trained together on one table: a row's features are cut once into at most
``max_bins`` levels (a byte each, edges from the ``BIN_SAMPLE`` rows of least hash), and a bit mask says which models it trains.
Trees grow level by level on histograms of first and second derivatives.  Derivatives are whole numbers (units of 2^-20), so sums
are exact, whatever the order and the number of tasks; row and column draws are hashes of (seed, model, round, row or column).  Scores therefore
depend on neither cores nor partitions, and the two ways to train give the same trees to the last bit:

* ``ROWS_IN_TASK`` rows or fewer a model: each model is grown in a task of its own, all in one Spark job; of every cut node only the smaller
  child is summed, its sibling's sums are the parent's less these.
* more: one job a level for all models.  A task sums the histograms of its rows, a shuffle by (model, node, feature) adds them up
  and finds each one's best cut there, and the driver sees only those (at most models x nodes x features rows of numbers).  Margins are
  stored every ``STORE_EVERY`` rounds; in between a task applies the trees since.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.functions import growing, stable_hash
from peerscope.models.smote import minority_knn, neighbours_outside, smote
from peerscope.operators.metrics import stratified_folds
from peerscope.session import materialize, ship_package

# The boosting configuration of the original scorer.
N_TREES = 400
MAX_DEPTH = 6
LEARNING_RATE = 0.05
ROW_SUBSAMPLE = 0.8
COL_SUBSAMPLE = 0.8
SEED = 42
# Defaults of the original's library.
RIDGE = 1.0
MIN_CHILD_WEIGHT = 1.0
MAX_BINS = 256

ROWS_IN_TASK = 5_000_000   # about 1 GB in a task
BIN_SAMPLE = 100_000
JOINT_BINS = 1 << 16
STORE_EVERY = 10
UNIT = float(1 << 20)
VERSION = 1


@dataclass
class BoostParams:
    n_trees: int = N_TREES
    max_depth: int = MAX_DEPTH
    learning_rate: float = LEARNING_RATE
    subsample: float = ROW_SUBSAMPLE
    feature_subset: float = COL_SUBSAMPLE
    seed: int = SEED
    oversample: bool = True
    parallelism: int = 6          # SMOTE runs at a time (one a model)
    max_bins: int = MAX_BINS
    few_minority: str = "raise"   # smote(): what to do with at most k minority rows
    rows_in_task: int = ROWS_IN_TASK


@dataclass
class BoostedModel:
    """Trees as arrays over a heap of nodes (children of i: 2i + 1 and 2i + 2): feature (-1: leaf), bin and value."""
    features: list[str]
    edges: list[np.ndarray]
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], 1).astype(np.uint8)

    def margins(self, x: np.ndarray) -> np.ndarray:
        b, out = self.bins(x), np.zeros(len(x))
        for tree in self.trees:
            out += _values(tree, b)
        return out

    def node_tables(self) -> list[tuple[np.ndarray, ...]]:
        """(feature, threshold, left, right, value) of each tree: left where x <= threshold."""
        out = []
        for feature, cut, value in self.trees:
            n = np.arange(len(feature))
            inner = feature >= 0
            threshold = np.array([self.edges[f][c] if f >= 0 else 0.0 for f, c in zip(feature, cut)])
            out.append((feature.astype(np.int64), threshold, np.where(inner, 2 * n + 1, -1), np.where(inner, 2 * n + 2, -1), value))
        return out


# -- arithmetic shared by both ways ---------------------------------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    """Mixes 64-bit whole numbers (finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _draw(own: np.ndarray, seed: int, model: int, number: int, salt: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from whole numbers, for a model and a round."""
    base = _mix(np.array([seed, model, number, salt], dtype=np.uint64) + np.array([1, 1 << 20, 1 << 40, 1 << 60], dtype=np.uint64))
    key = np.bitwise_xor.reduce(base)
    return (_mix(own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ key) >> np.uint64(11)) / float(1 << 53)


def _columns(n: int, p: BoostParams, model: int, number: int) -> np.ndarray:
    """Mask of the features a tree may use."""
    keep = max(1, int(p.feature_subset * n))
    out = np.zeros(n, dtype=bool)
    out[np.argsort(_draw(np.arange(n), p.seed, model, number, 2), kind="stable")[:keep]] = True
    return out


def _derivatives(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``rint(UNIT weight (p - label))`` and ``rint(UNIT weight p (1 - p))``, in few arrays."""
    prob = np.negative(margin)
    np.exp(prob, out=prob)
    prob += 1.0
    np.divide(1.0, prob, out=prob)
    g, h = prob - label, UNIT * weight
    g *= h
    h *= prob
    h *= np.subtract(1.0, prob, out=prob)
    return np.rint(g, out=g), np.rint(h, out=h)


def _empty(depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = (2 << depth) - 1
    return np.full(n, -1, dtype=np.int16), np.zeros(n, dtype=np.int16), np.zeros(n)


def _values(tree, b: np.ndarray) -> np.ndarray:
    return tree[2][_places(tree, b)]


def _places(tree, b: np.ndarray) -> np.ndarray:
    """The node in which each row ends."""
    feature, cut, _ = tree
    place, rows = np.zeros(len(b), dtype=np.int64), np.arange(len(b))
    while True:
        f = feature[place[rows]]
        rows = rows[f >= 0]
        if not rows.size:
            return place
        at = place[rows]
        place[rows] = 2 * at + 1 + (b[rows, feature[at]] > cut[at])


def _histograms(b: np.ndarray, g: np.ndarray, h: np.ndarray, place: np.ndarray, nodes: np.ndarray, bins: int) -> np.ndarray:
    """[node, feature, bin, (g, h)] sums over rows whose place is one of ``nodes``."""
    slot_of = np.full(int(max(place.max(initial=0), nodes.max())) + 1, -1, dtype=np.int64)
    slot_of[nodes] = np.arange(nodes.size)
    slot = slot_of[place]
    some = np.flatnonzero(slot >= 0)
    n = b.shape[1]
    index = ((slot[some, None] * n + np.arange(n)) * bins + b[some]).ravel()
    shape = (nodes.size, n, bins)
    return np.stack([np.bincount(index, weights=np.repeat(v[some], n), minlength=nodes.size * n * bins).reshape(shape) for v in (g, h)], 3)


def _cuts(hist: np.ndarray) -> tuple[np.ndarray, ...]:
    """Best cut of each [node, feature] histogram: gain, bin, g and h on the left, g and h in all."""
    left = np.cumsum(hist, 2)
    total = left[:, :, -1:]
    right = total - left

    def part(x: np.ndarray) -> np.ndarray:
        return x[..., 0] * x[..., 0] / (x[..., 1] + RIDGE * UNIT)

    least = MIN_CHILD_WEIGHT * UNIT
    gain = np.where((left[..., 1] >= least) & (right[..., 1] >= least), (part(left) + part(right) - part(total)) / UNIT, -1.0)
    at = gain.argmax(2)
    take = at[..., None]
    best = np.take_along_axis(left, take[..., None], 2)[:, :, 0]
    return np.take_along_axis(gain, take, 2)[..., 0], at, best[..., 0], best[..., 1], total[:, :, 0, 0], total[:, :, 0, 1]


def _grow(tree, nodes: Sequence[int], cuts: Sequence[np.ndarray], allowed: np.ndarray, p: BoostParams) -> list[int]:
    """Applies the best allowed cut of each node; the nodes of the next level that may be cut further."""
    feature, cut, value = tree
    gain, at, lg, lh, g, h = cuts
    out = []
    for k, node in enumerate(nodes):
        if node == 0:
            value[0] = _leaf(g[k, 0], h[k, 0], p)
        own = np.where(allowed, gain[k], -1.0)
        f = int(own.argmax())
        if own[f] <= 1e-6:
            continue
        feature[node], cut[node] = f, at[k, f]
        sides = ((lg[k, f], lh[k, f]), (g[k, f] - lg[k, f], h[k, f] - lh[k, f]))
        for child, (cg, ch) in zip((2 * node + 1, 2 * node + 2), sides):
            value[child] = _leaf(cg, ch, p)
            if ch >= 2 * MIN_CHILD_WEIGHT * UNIT and 2 * child + 2 < len(feature):
                out.append(child)
    return out


def _leaf(g: float, h: float, p: BoostParams) -> float:
    return -p.learning_rate * g / (h + RIDGE * UNIT)


# -- training table -------------------------------------------------------------------------------------------------------------

def positive_weight(matrix: DataFrame, label: str = "is_fraud_label") -> float:
    """n0 / n1 over the full table (one-row aggregate)."""
    r = matrix.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")).collect()[0]
    return float(r["n0"]) / float(r["n1"]) if r["n1"] else 1.0


def _filled(matrix: DataFrame, feats: Sequence[str], *others: str) -> DataFrame:
    return matrix.select(*others, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in feats])


def bin_edges(matrix: DataFrame, feats: Sequence[str], key: str, max_bins: int) -> list[np.ndarray]:
    """Upper edges of all bins but the last, from the ``BIN_SAMPLE`` rows whose key has the least hash."""
    rows = _filled(matrix, feats, key)
    n = rows.count()
    if n > BIN_SAMPLE:      # the rows are sorted in one task, so those whose hash is too large do not go there
        h = stable_hash(F.col(key))
        some = rows.where(h.isNull() | (h < F.lit(int(1.1 * (1 << 32) * BIN_SAMPLE / n))))
        rows = some if some.count() >= BIN_SAMPLE else rows
    sample = rows.orderBy(stable_hash(F.col(key)), key).limit(BIN_SAMPLE).select(*feats).toArrow()
    out = []
    for c in feats:
        x = np.sort(sample.column(c).to_numpy())
        distinct = np.unique(x)
        if distinct.size > max_bins:
            distinct = np.unique(x[np.linspace(0, x.size - 1, max_bins).astype(np.int64)])
        out.append((distinct[:-1] + distinct[1:]) / 2 if distinct.size <= max_bins else distinct[:-1])
    return out


def _binned(rows: DataFrame, feats: Sequence[str], key: str, label: str, edges: list[np.ndarray], weight: float) -> DataFrame:
    """key, fold, models (bit mask), label, weight, h (row hash) and the bins as bytes."""
    ship_package(rows.sparkSession)
    model = BoostedModel(list(feats), edges)
    n = len(feats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in feats], 1) if batch.num_rows else np.zeros((0, n))
            blob = pa.array([r.tobytes() for r in model.bins(x)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("key", "fold", "models", "label", "weight", "h")] + [blob],
                                             names=["key", "fold", "models", "label", "weight", "h", "bins"])

    y = F.col(label).cast("double")
    own = _filled(rows, feats, F.col(key).alias("key"), "fold", "models", y.alias("label"),
                  F.when(y == 1, F.lit(float(weight))).otherwise(F.lit(1.0)).alias("weight"), stable_hash(F.col(key)).alias("h"))
    return own.mapInArrow(run, "key string, fold int, models int, label double, weight double, h long, bins binary")


def _training_table(data: DataFrame, feats: list[str], label: str, key: str, edges: list[np.ndarray], weight: float, numbers: Sequence[int],
                    p: BoostParams, synthetic: DataFrame | None) -> DataFrame:
    """All rows of all models.  ``data`` has ``fold``; model 0 trains on all rows, model f on those of the other folds."""
    every = sum(1 << m for m in numbers)
    own = F.lit(every).bitwiseAND(F.bitwise_not(F.when(F.col("fold") > 0, F.expr("shiftleft(1, fold)")).otherwise(F.lit(0)))).cast("int")
    rows = data.select(key, *feats, label, "fold", own.alias("models"))
    if p.oversample:
        # the neighbours of all models in one search: a list a fold, merged for each model
        minority = data.where(F.col(label) == 1)
        knn = minority_knn(minority, feats, key, group="fold") if any(numbers) or synthetic is None else None

        def drawn(m: int) -> DataFrame:
            if m == 0 and synthetic is not None:
                syn = synthetic
            else:
                train = data.where(F.col("fold") != m) if m else data
                near = neighbours_outside(knn, minority, m or None, key)
                syn = smote(train.select(key, *feats, label), feats, label, key, seed=p.seed, few=p.few_minority, knn=near)
            return syn.select(key, *feats, label, F.lit(None).cast("int").alias("fold"), F.lit(1 << m).alias("models"))

        with ThreadPoolExecutor(max_workers=max(1, p.parallelism)) as pool:     # independent runs, submitted as concurrent Spark jobs
            for syn in pool.map(drawn, numbers):
                rows = rows.unionByName(syn)
    return materialize(_binned(rows, feats, key, label, edges, weight), "training")


def _bytes(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    """A column of ``n`` bytes a row as a matrix, without an object a row."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    own = [c.cast(pa.binary(n)) for c in chunks if len(c)]
    own = [np.frombuffer(c.buffers()[1], dtype=np.uint8)[n * c.offset:n * (c.offset + len(c))] for c in own]
    return (np.concatenate(own) if own else np.zeros(0, dtype=np.uint8)).reshape(-1, n)


def _arrays(table: pa.Table | pa.RecordBatch, n: int) -> tuple[np.ndarray, ...]:
    return _bytes(table.column("bins"), n), *(table.column(c).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table.column(c).to_numpy()
                   for c in ("label", "weight", "h", "models"))


# -- all rounds of a model in a task --------------------------------------------------------------------------------------------

def _packed(sizes: Sequence[int], most: int) -> list[list[int]]:
    """Features in groups whose numbers of bins multiply to at most ``most`` (or that are alone), the small ones together."""
    out, held = [], most + 1
    for j in np.argsort(sizes, kind="stable").tolist():
        if held * sizes[j] > most:
            out.append([])
            held = 1
        out[-1].append(j)
        held *= sizes[j]
    return out


def _joint(columns: np.ndarray) -> list[tuple[list[int], list[int], np.ndarray]]:
    """The columns in groups: (columns, their numbers of bins, joint bin of each row)."""
    sizes, out = (columns.max(1, initial=0).astype(int) + 1).tolist(), []
    for group in _packed(sizes, JOINT_BINS):
        index = columns[group[0]].astype(np.uint16)
        for j in group[1:]:
            index *= np.uint16(sizes[j])
            index += columns[j]
        out.append((group, [sizes[j] for j in group], index))
    return out


def _sums_of(columns: np.ndarray, rows: np.ndarray, g: np.ndarray, h: np.ndarray, bins: int, joint: Sequence[tuple] = ()) -> np.ndarray:
    """[feature, bin, (g, h)] sums over ``rows`` of the transposed bins; ``g`` and ``h`` are those of the rows.  Of many rows the features of a
    ``joint`` group are summed at once over their joint bins, of which each one's sums are the margins: whole numbers, so the same to the last bit."""
    out = np.zeros((len(columns), bins, 2))
    for group, shape, index in joint or [([j], [bins], None) for j in range(len(columns))]:
        many = len(group) > 1 and math.prod(shape) <= 4 * rows.size
        for own, sizes, column in [(group, shape, index)] if many else [([j], [bins], columns[j]) for j in group]:
            at = (column if rows.size == column.size else column.take(rows)).astype(np.int64)       # as many as all: all, in order
            for k, weights in enumerate((g, h)):
                sums = np.bincount(at, weights=weights, minlength=math.prod(sizes)).reshape(sizes)
                for i, j in enumerate(own):
                    out[j, :sizes[i], k] = sums.sum(tuple(x for x in range(len(own)) if x != i)) if many else sums
    return out


def _spread(cuts: tuple[np.ndarray, ...], used: np.ndarray, n: int) -> list[np.ndarray]:
    """Cuts of the ``used`` features as those of all ``n``; the others gain nothing."""
    gain, at, lg, lh, g, h = cuts
    out = [np.full((len(gain), n), -1.0), np.zeros((len(gain), n), dtype=np.int64), *(np.zeros((len(gain), n)) for _ in range(2))]
    for full, own in zip(out, (gain, at, lg, lh)):
        full[:, used] = own
    return [*out, np.repeat(g[:, :1], n, 1), np.repeat(h[:, :1], n, 1)]       # the sums over all bins are those of any feature


def _grow_in_task(columns: np.ndarray, rows: np.ndarray, g: np.ndarray, h: np.ndarray, allowed: np.ndarray, bins: int, p: BoostParams) -> tuple:
    """A tree on ``rows`` (with derivatives ``g``, ``h``), and the node in which each of them ends.  A level reads only the rows of the smaller
    child of each cut node and the features the tree may use: the sums are exact, so the sibling's are the parent's less these."""
    tree, used, nodes = _empty(p.max_depth), np.flatnonzero(allowed), [0]
    some = np.stack([columns[f].take(rows) for f in used])
    joint = _joint(some) if rows.size >= JOINT_BINS else ()             # few rows would fill few of the joint bins
    where = {int(f): j for j, f in enumerate(used)}
    held = {0: np.arange(rows.size)}                                    # node: places in ``rows``
    sums = {0: _sums_of(some, held[0], g, h, bins, joint)}
    place = np.zeros(rows.size, dtype=np.int64)
    while nodes:
        after = _grow(tree, nodes, _spread(_cuts(np.stack([sums[k] for k in nodes])), used, len(columns)), allowed, p)
        below = {}
        for node in nodes:
            mine, total = held.pop(node), sums.pop(node)
            f = int(tree[0][node])
            if f < 0:
                place[mine] = node
                continue
            column = some[where[f]]
            right = (column if mine.size == column.size else column.take(mine)) > tree[1][node]
            open_ = [c for c in (2 * node + 1, 2 * node + 2) if c in after]
            if not open_:
                place[mine] = 2 * node + 1 + right
            else:
                sides = {2 * node + 1: mine.take(np.flatnonzero(~right)), 2 * node + 2: mine.take(np.flatnonzero(right))}
                for c in sides.keys() - after:
                    place[sides[c]] = c
                small = min(sides, key=lambda c: sides[c].size)
                own = sides[small]
                part = _sums_of(some, own, g.take(own), h.take(own), bins, joint)
                below |= {c: part if c == small else total - part for c in open_}
                held |= {c: sides[c] for c in open_}
        nodes, sums = after, below
    return tree, place


def _ends_of(tree, columns: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The node in which each of ``rows`` ends, as ``_places`` has it: each node reads the one column it cuts."""
    feature, cut, _ = tree
    place, held = np.zeros(rows.size, dtype=np.int64), [(0, np.arange(rows.size))]
    while held:
        node, mine = held.pop()
        f = int(feature[node])
        if f < 0:
            place[mine] = node
        elif mine.size:
            right = columns[f].take(rows.take(mine)) > cut[node]
            held += [(2 * node + 1, mine.take(np.flatnonzero(~right))), (2 * node + 2, mine.take(np.flatnonzero(right)))]
    return place


def _train_in_task(b: np.ndarray, label: np.ndarray, weight: np.ndarray, h: np.ndarray, model: int, bins: int, p: BoostParams) -> list:
    margin, trees = np.zeros(len(b)), []
    columns = np.ascontiguousarray(b.T)
    for number in range(p.n_trees):
        drawn = _draw(h, p.seed, model, number, 1) < p.subsample
        rows, others = np.flatnonzero(drawn), np.flatnonzero(~drawn)
        g, hess = _derivatives(margin.take(rows), label.take(rows), weight.take(rows))
        tree, place = _grow_in_task(columns, rows, g, hess, _columns(b.shape[1], p, model, number), bins, p)
        trees.append(tree)
        margin[rows] += tree[2].take(place)
        margin[others] += tree[2].take(_ends_of(tree, columns, others))
    return trees


def _fit_in_tasks(table: DataFrame, numbers: Sequence[int], n: int, bins: int, p: BoostParams) -> tuple[dict[int, list], DataFrame]:
    def run(group: tuple, rows: pa.Table) -> pa.Table:
        model = group[0].as_py()
        b, label, weight, h, models = _arrays(rows, n)
        trains = (models >> model) & 1 == 1
        trees = _train_in_task(b[trains], label[trains], weight[trains], h[trains], model, bins, p)
        held = np.flatnonzero(~trains)
        margin = np.zeros(held.size)
        for t in trees:
            margin += _values(t, b[held])
        packed = [b"".join(x.tobytes() for x in t) for t in trees]
        scored = rows.column("key").filter(pa.array(~trains))
        names = ["model", "number", "tree", "key", "margin"]
        grown = pa.table([pa.array([model] * len(trees), pa.int32()), pa.array(range(len(trees)), pa.int32()), pa.array(packed, pa.binary()),
                          pa.nulls(len(trees), pa.string()), pa.nulls(len(trees), pa.float64())], names=names)
        return pa.concat_tables([grown, pa.table([pa.array(np.full(held.size, model, dtype=np.int32)), pa.nulls(held.size, pa.int32()),
                                                  pa.nulls(held.size, pa.binary()), scored.cast(pa.string()), pa.array(margin)], names=names)])

    each = table.withColumn("model", F.explode(F.array(*[F.lit(m) for m in numbers]))).where(
        (F.expr("shiftright(models, model) & 1") == 1) | (F.col("fold") == F.col("model")))
    # a task a model: as many partitions as it takes for their hashes to be apart (few, and a count given by name is not coalesced)
    spark = table.sparkSession
    hashes = spark.range(1).select(*[F.hash(F.lit(m)).alias(f"m{m}") for m in numbers]).first()
    parts = next((k for k in range(len(hashes), 20 * len(hashes)) if len({h % k for h in hashes}) == len(hashes)), 20 * len(hashes))
    each = each.repartition(parts, "model")
    out = materialize(each.groupBy("model").applyInArrow(run, "model int, number int, tree binary, key string, margin double"), "boosted")
    trees: dict[int, list] = {m: [] for m in numbers}
    size = (2 << p.max_depth) - 1
    for r in out.where("number is not null").orderBy("model", "number").collect():     # models x rounds trees
        raw = bytes(r.tree)
        trees[r.model].append((np.frombuffer(raw[:2 * size], np.int16), np.frombuffer(raw[2 * size:4 * size], np.int16), np.frombuffer(raw[4 * size:], np.float64)))
    return trees, out.where("number is null").select("key", F.col("model").alias("fold"), "margin")


# -- one job a level ------------------------------------------------------------------------------------------------------------

def _fit_by_level(table: DataFrame, numbers: Sequence[int], n: int, bins: int, p: BoostParams) -> tuple[dict[int, list], DataFrame]:
    spark = table.sparkSession
    numbers = list(numbers)
    trees: dict[int, list] = {m: [] for m in numbers}

    def margins_of(batch, since) -> np.ndarray:
        out = np.stack([np.array(batch.column("margins").to_pylist(), dtype=np.float64).reshape(-1, len(numbers))[:, j] for j in range(len(numbers))], 1)
        b = _bytes(batch.column("bins"), n)
        for j, m in enumerate(numbers):
            for t in since[m]:
                out[:, j] += _values(t, b)
        return out

    def level(stored: DataFrame, shipped, number: int) -> list:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            since, partial, open_ = shipped.value
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                if not batch.num_rows:
                    continue
                b, label, weight, h, models = _arrays(batch, n)
                margin = margins_of(batch, since)
                for j, m in enumerate(numbers):
                    rows = np.flatnonzero(((models >> m) & 1 == 1) & (_draw(h, p.seed, m, number, 1) < p.subsample))
                    if open_[m] and rows.size:
                        g, hess = _derivatives(margin[rows, j], label[rows], weight[rows])
                        hist = _histograms(b[rows], g, hess, _places(partial[m], b[rows]), np.array(open_[m]), bins)
                        total[m] = total[m] + hist if m in total else hist
            found = [(m, node, f, total[m][k, f].tobytes()) for m in total for k, node in enumerate(open_[m]) for f in range(n)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
                                             names=["model", "node", "feature", "sums"])

        def best(rows: pa.Table) -> pa.Table:
            hist = sum(np.frombuffer(x, np.float64) for x in rows.column("sums").to_pylist()).reshape(1, 1, bins, 2)
            own = [float(x[0, 0]) for x in _cuts(hist)]
            return pa.table({c: [rows.column(c)[0].as_py()] for c in ("model", "node", "feature")} | {"cut": [own]},
                            schema=pa.schema([("model", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("cut", pa.list_(pa.float64()))]))

        return stored.mapInArrow(sums, "model int, node int, feature int, sums binary").groupBy("model", "node", "feature").applyInArrow(
            best, "model int, node int, feature int, cut array<double>").collect()

    def carried(stored: DataFrame, since) -> DataFrame:
        names = stored.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    m = pa.array(margins_of(batch, since.value).tolist(), pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays([m if c == "margins" else batch.column(c) for c in names], names=names)

        return materialize(stored.mapInArrow(run, stored.schema), "margins")

    ship_package(spark)
    stored = materialize(table.withColumn("margins", F.array(*[F.lit(0.0)] * len(numbers))), "margins")
    since: dict[int, list] = {m: [] for m in numbers}
    for number in range(p.n_trees):
        partial = {m: _empty(p.max_depth) for m in numbers}
        open_ = {m: [0] for m in numbers}
        while any(open_.values()):
            got = level(stored, spark.sparkContext.broadcast((since, partial, open_)), number)
            for m in numbers:
                nodes = open_[m]
                cuts = [np.zeros((len(nodes), n)) for _ in range(6)]
                at = {node: k for k, node in enumerate(nodes)}
                cuts[0] -= 1.0
                for r in got:
                    if r.model == m:
                        for c, v in zip(cuts, r.cut):
                            c[at[r.node], r.feature] = v
                open_[m] = _grow(partial[m], nodes, cuts, _columns(n, p, m, number), p) if nodes else []
        for m in numbers:
            trees[m].append(partial[m])
            since[m] = since[m] + [partial[m]]
        if (number + 1) % STORE_EVERY == 0 or number + 1 == p.n_trees:
            stored = carried(stored, spark.sparkContext.broadcast(since))
            since = {m: [] for m in numbers}
    place = F.create_map(*[x for j, m in enumerate(numbers) for x in (F.lit(m), F.lit(j))])
    return trees, stored.where(F.col("fold").isin([m for m in numbers if m])).select("key", "fold", F.get("margins", place[F.col("fold")]).alias("margin"))


# -- entry points ---------------------------------------------------------------------------------------------------------------

def _train(data: DataFrame, feats: list[str], label: str, key: str, numbers: Sequence[int], p: BoostParams, pos_weight: float | None,
           synthetic: DataFrame | None) -> tuple[dict[int, BoostedModel], DataFrame]:
    if not 2 <= p.max_bins <= 256:
        raise ValueError("max_bins must be 2 to 256: a bin is a byte")
    ship_package(data.sparkSession)
    edges = bin_edges(data, feats, key, p.max_bins)
    weight = positive_weight(data, label) if pos_weight is None else pos_weight
    table = _training_table(data, feats, label, key, edges, weight, numbers, p, synthetic)
    bins = max((len(e) for e in edges), default=0) + 1
    most = table.agg(*[F.sum(F.expr(f"shiftright(models, {m}) & 1")).alias(f"m{m}") for m in numbers]).first()
    train = _fit_in_tasks if max((x or 0) for x in most) <= p.rows_in_task else _fit_by_level
    trees, held = train(table, numbers, len(feats), bins, p)
    return {m: BoostedModel(feats, edges, t) for m, t in trees.items()}, held


def fit(matrix: DataFrame, features: Sequence[str], label: str = "is_fraud_label", key: str = "npi", params: BoostParams | None = None,
        pos_weight: float | None = None, synthetic: DataFrame | None = None) -> BoostedModel:
    """Fit on all rows (oversampled) -- the model kept for scoring and attribution.
    ``synthetic`` may pass SMOTE rows already drawn for the same table."""
    data = matrix.withColumn("fold", F.lit(0))
    return _train(data, list(features), label, key, [0], params or BoostParams(), pos_weight, synthetic)[0][0]


def fit_all(matrix: DataFrame, features: Sequence[str], label: str = "is_fraud_label", key: str = "npi", k: int = 5,
            params: BoostParams | None = None, synthetic: DataFrame | None = None, refit: bool = True) -> tuple[DataFrame, BoostedModel | None]:
    """M4 in one pass: (``key``, ``fold`` and the out-of-fold ``fraud_score_xgb``; the model of all rows)."""
    feats = list(features)
    data = _filled(matrix, feats, key, label)
    folds = stratified_folds(data.select(key, label), label, key, k)
    data = materialize(data.join(growing(folds.select(key, "fold")), key, "inner"), "cv_data")
    models, held = _train(data, feats, label, key, ([0] if refit else []) + list(range(1, k + 1)), params or BoostParams(), None, synthetic)
    return held.select(F.col("key").alias(key), "fold", (1.0 / (1.0 + F.exp(-F.col("margin")))).alias("fraud_score_xgb")), models.get(0)


def out_of_fold_scores(matrix: DataFrame, features: Sequence[str], label: str = "is_fraud_label", key: str = "npi", k: int = 5,
                       params: BoostParams | None = None) -> DataFrame:
    """M4: ``key``, ``fold`` and the out-of-fold ``fraud_score_xgb``."""
    return fit_all(matrix, features, label, key, k, params, refit=False)[0]


def predict(model: BoostedModel, rows: DataFrame, key: str = "npi") -> DataFrame:
    """``key`` and the positive-class probability; only the model (bounded by its parameters) is shipped."""
    ship_package(rows.sparkSession)
    feats, own = model.features, rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in feats], 1)
                yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(1.0 / (1.0 + np.exp(-own.value.margins(x))))], names=[key, "fraud_score_xgb"])

    return _filled(rows, feats, key).mapInArrow(run, f"{key} string, fraud_score_xgb double")


def save_model(model: BoostedModel, path: str, spark: SparkSession, **settings) -> None:
    """Node table, bin edges, feature order and further ``settings`` (a threshold, say) in one folder."""
    nodes = [(t, i, int(f), int(c), float(v)) for t, (fe, cu, va) in enumerate(model.trees) for i, (f, c, v) in enumerate(zip(fe, cu, va))]
    spark.createDataFrame(nodes, "tree int, node int, feature int, bin int, value double").coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    edges = [(j, c, model.edges[j].tolist()) for j, c in enumerate(model.features)]
    spark.createDataFrame(edges, "place int, feature string, edges array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
    spark.createDataFrame([(VERSION, json.dumps(settings))], "version int, settings string").coalesce(1).write.mode("overwrite").json(f"{path}/settings")


def load_model(path: str, spark: SparkSession) -> tuple[BoostedModel, dict]:
    """The model and the settings that ``save_model`` has written."""
    head = spark.read.schema("version int, settings string").json(f"{path}/settings").first()
    if head is None or head.version != VERSION:
        raise ValueError(f"{path} is not a model of version {VERSION}")
    feats = sorted(spark.read.parquet(f"{path}/features").collect(), key=lambda r: r.place)
    nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").toPandas()        # bounded by the model's size
    trees = [(g.feature.to_numpy(np.int16), g.bin.to_numpy(np.int16), g.value.to_numpy(np.float64)) for _, g in nodes.groupby("tree", sort=True)]
    return BoostedModel([r.feature for r in feats], [np.array(r.edges, dtype=np.float64) for r in feats], trees), json.loads(head.settings)
