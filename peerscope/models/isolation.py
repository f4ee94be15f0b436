"""Isolation scoring (unsupervised): a forest of random isolation trees
(Liu, Ting and Zhou, 2008).  Higher score = more anomalous.

Every draw is a hash, so the forest depends on the rows and the seed alone, not on partitions or cores, and SQL can
grow the same one (``m5_isolation_scores``).

Spark plan
----------
1. Sampling: tree ``t`` is grown on the ``psi = min(max_samples, N)`` rows
   with the smallest ``(a_t * h + b_t) mod P``, where ``h`` is one md5 of the row's key and
   ``a_t``, ``b_t`` come from an md5 of (seed, tree): a multiplication a row and tree.  Rows are first kept for tree ``t`` when
   the draw is below a few times ``psi / N`` (a narrow, pipelined filter
   on the row's array of trees), so only ~``4 * psi`` candidates per tree are
   shuffled, of which the JVM keeps the ``psi`` smallest; a tree left with
   fewer than ``psi`` candidates is redrawn with a larger bound (exact either way).
2. Growing: ``groupBy(tree).applyInPandas`` -- one task per tree, each with a
   bounded sample -- returns the node table.  Nodes are numbered as in a heap (children ``2n`` and ``2n + 1``); feature and
   threshold of a node come from md5(seed, tree, node) and the node's minima and maxima.
3. Scoring: the node table is bounded by ``n_trees * (2 * psi - 1)`` rows
   (proven by the parameters), so it is collected once and broadcast; a
   ``mapInPandas`` pass walks all trees for each Arrow batch of rows.
4. ``score = 2 ** (-E[h(x)] / c(psi))``, min-max scaled to [0, 1].  Path lengths are summed as whole numbers of 1e-9.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerscope.operators.scoring import minmax_scale
from peerscope.session import materialize, ship_package

N_TREES = 200
MAX_SAMPLES = 256
SEED = 42
OVERSAMPLE = 4.0
EULER_GAMMA = 0.5772156649015329
PRIME = 2 ** 31 - 1
PATH_UNITS = 10 ** 9

NODE_SCHEMA = "tree int, node long, feature int, threshold double, depth int, size long"


def average_path_length(n: np.ndarray | float) -> np.ndarray:
    """c(n): mean path length of an unsuccessful search in a binary search tree of n items."""
    n = np.asarray(n, dtype="float64")
    out = np.zeros_like(n)
    out = np.where(n == 2, 1.0, out)
    big = n > 2
    out = np.where(big, 2.0 * (np.log(np.where(big, n - 1, 1)) + EULER_GAMMA) - 2.0 * (n - 1) / np.where(big, n, 1),
                   out)
    return out


def _words(text: str) -> tuple[int, int]:
    """The first two 32-bit words of an md5."""
    d = hashlib.md5(text.encode(), usedforsecurity=False).hexdigest()
    return int(d[:8], 16), int(d[8:16], 16)


def tree_draws(seed: int, tree: int) -> tuple[int, int]:
    """Multiplier and offset of a tree's row draw."""
    a, b = _words(f"{seed}-{tree}")
    return 1 + a % (PRIME - 1), b % PRIME


def _grow(features: Sequence[str], max_depth: int, seed: int):
    feats = list(features)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        X = pdf[feats].to_numpy(dtype="float64")
        stack = [(1, np.arange(len(X)), 0)]
        rows = []
        while stack:
            node, idx, depth = stack.pop()
            if depth < max_depth and len(idx) > 1:
                lo, hi = X[idx].min(axis=0), X[idx].max(axis=0)
                varied = np.flatnonzero(hi > lo)
                if len(varied):
                    pick, place = _words(f"{seed}-{tree}-{node}")
                    f = int(varied[pick * len(varied) >> 32])
                    thr = float(lo[f] + place / 4294967296.0 * (hi[f] - lo[f]))
                    left = X[idx, f] <= thr
                    rows.append([tree, node, f, thr, depth, len(idx)])
                    stack += [(2 * node, idx[left], depth + 1), (2 * node + 1, idx[~left], depth + 1)]
                    continue
            rows.append([tree, node, -1, 0.0, depth, len(idx)])
        return pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "depth", "size"])

    return grow


def grow_forest(matrix: DataFrame, features: Sequence[str], key: str = "npi", n_trees: int = N_TREES,
                max_samples: int = MAX_SAMPLES, seed: int = SEED) -> tuple[DataFrame, int]:
    """Node table of the forest and the per-tree sample size ``psi``."""
    feats = list(features)
    ship_package(matrix.sparkSession)
    n = matrix.count()
    psi = int(min(max_samples, n))
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    hashed = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") % PRIME
    rows = matrix.select(F.col(key).alias("_key"), hashed.alias("_h"),
                         *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in feats])

    def draw(ids: list[int], p: float) -> DataFrame:
        """Rows whose draw is below ``p`` of the range for the given trees.  The trees of a row are filtered as an array, so a
        row is only copied for the trees that take it; stored once so that the count and the sample read the same rows."""
        draws = F.array(*[F.struct(F.lit(t).alias("tree"), *[F.lit(v).cast("long").alias(n) for n, v in zip(("_a", "_b"), tree_draws(seed, t))])
                          for t in ids])
        taken = F.filter(draws, lambda d: (d["_a"] * F.col("_h") + d["_b"]) % PRIME < F.lit(math.ceil(p * PRIME)))
        own = rows.select("*", F.inline(taken))
        return materialize(own.withColumn("_u", (F.col("_a") * F.col("_h") + F.col("_b")) % PRIME).drop("_a", "_b", "_h"), "iso_candidates")

    missing, p, parts = list(range(n_trees)), min(1.0, OVERSAMPLE * psi / max(n, 1)), []
    while missing:
        cand = draw(missing, p)
        # exactness guard: trees with fewer than psi candidates are drawn again, eight times as many
        have = [r.tree for r in cand.groupBy("tree").count().where(F.col("count") >= psi).select("tree").collect()]
        parts.append(cand.where(F.col("tree").isin(have)) if p < 1.0 else cand)
        missing = sorted(set(missing) - set(have)) if p < 1.0 else []      # at most n_trees ids
        p = min(1.0, 8 * p)
    sample = parts[0]
    for more in parts[1:]:
        sample = sample.unionByName(more)
    first = Window.partitionBy("tree").orderBy("_u", "_key")
    sample = sample.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= psi).drop("_n")
    nodes = sample.groupBy("tree").applyInPandas(_grow(feats, max_depth, seed), NODE_SCHEMA)
    return nodes, psi


def score_forest(matrix: DataFrame, nodes: DataFrame, psi: int, features: Sequence[str],
                 key: str = "npi") -> DataFrame:
    """``key`` and the raw isolation score ``2 ** (-E[h] / c(psi))``."""
    feats = list(features)
    spark = matrix.sparkSession
    ship_package(spark)
    # bounded by n_trees * (2 * psi - 1) rows (model parameters): collect once, broadcast
    table = nodes.orderBy("tree", "node").toPandas()
    place = {(t, n): i for i, (t, n) in enumerate(zip(table.tree, table.node))}
    feature = table.feature.to_numpy(dtype="int64")
    threshold = table.threshold.to_numpy(dtype="float64")
    left = np.array([place.get((t, 2 * n), -1) for t, n in zip(table.tree, table.node)], dtype="int64")
    right = np.array([place.get((t, 2 * n + 1), -1) for t, n in zip(table.tree, table.node)], dtype="int64")
    leaf_len = np.rint((table.depth.to_numpy(dtype="float64") + average_path_length(table["size"].to_numpy())) * PATH_UNITS).astype("int64")
    roots = np.flatnonzero(table.node.to_numpy() == 1)
    model = spark.sparkContext.broadcast((feature, threshold, left, right, leaf_len, roots))
    denom = float(average_path_length(np.array([psi]))[0]) or 1.0

    def walk(batches):
        fe, th, le, ri, ll, rt = model.value
        for pdf in batches:
            X = pdf[feats].fillna(0.0).to_numpy(dtype="float64")
            n = len(X)
            total = np.zeros(n, dtype="int64")
            rows = np.arange(n)
            for r in rt:
                cur = np.full(n, r, dtype="int64")
                while True:
                    f = fe[cur]
                    inner = f >= 0
                    if not inner.any():
                        break
                    fi = np.where(inner, f, 0)
                    go_left = X[rows, fi] <= th[cur]
                    cur = np.where(inner, np.where(go_left, le[cur], ri[cur]), cur)
                total += ll[cur]
            eh = total / PATH_UNITS / len(rt)
            yield pd.DataFrame({key: pdf[key], "iso_raw": np.power(2.0, -eh / denom)})

    cols = [F.col(key)] + [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in feats]
    return matrix.select(*cols).mapInPandas(walk, f"{key} string, iso_raw double")


def isolation_scores(matrix: DataFrame, features: Sequence[str], key: str = "npi", n_trees: int = N_TREES,
                     max_samples: int = MAX_SAMPLES, seed: int = SEED) -> DataFrame:
    """M5 + M6: ``key`` and ``fraud_score_iso`` in [0, 1] (min-max of the raw score)."""
    nodes, psi = grow_forest(matrix, features, key, n_trees, max_samples, seed)
    raw = score_forest(matrix, nodes, psi, features, key)
    return minmax_scale(raw, "iso_raw", "fraud_score_iso").select(key, "fraud_score_iso")
