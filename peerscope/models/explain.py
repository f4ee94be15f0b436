"""Per-provider attribution of the supervised score (interventional Shapley
values for tree ensembles; Lundberg et al., 2020).

For a foreground row ``x`` and a background row ``z`` a tree's output under
"features in S take x's value, the rest z's" is a set function; its Shapley
values have a closed form along the root-to-leaf paths that x and z can
jointly reach: at a leaf reached with ``a`` features following x only and
``b`` following z only, each x-feature receives ``v * (a-1)! b! / (a+b)!``
and each z-feature ``-v * a! (b-1)! / (a+b)!``.  Averaging over the
background gives the attribution; the values add up to
``f(x) - mean_z f(z)`` (checked in the tests).

Spark plan: the model's nodes are bounded by ``n_trees * (2^(depth+1) - 1)``, the background is a fixed
size reproducible sample, the foreground is the top-k rows -- all three are
bounded by parameters and broadcast; ``mapInPandas`` spreads the foreground
rows over tasks.  Contributions are in log-odds (the margin).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.models.boost import BoostedModel
from peerscope.operators.reports import sample_fixed
from peerscope.session import ship_package

# The original hands its 500 top rows to the explainer library, whose background masker keeps 100 of them by
# default; so the background is 100 rows drawn from the explained ones (hash order).
N_BACKGROUND = 100
ROWS_PER_TASK = 64


def leaves_of(trees, weights) -> list[tuple]:
    """Every leaf as ``(features on its path, lower bounds, upper bounds, weighted value)``: a row
    satisfies a feature of the path when ``lower < x <= upper``."""
    out = []
    for (fe, th, le, ri, va), w in zip(trees, weights):
        stack = [(0, {})]
        while stack:
            n, box = stack.pop()
            f = int(fe[n])
            if f < 0:
                feats = sorted(box)
                out.append((np.array(feats, dtype="int64"), np.array([box[x][0] for x in feats]),
                            np.array([box[x][1] for x in feats]), float(w * va[n])))
                continue
            lo, hi = box.get(f, (-np.inf, np.inf))
            stack.append((int(le[n]), {**box, f: (lo, min(hi, th[n]))}))
            stack.append((int(ri[n]), {**box, f: (max(lo, th[n]), hi)}))
    return out


@lru_cache(maxsize=None)
def _share(k: int) -> np.ndarray:
    """``[x mask, z mask, feature]``: the Shapley share of each of a path's ``k`` features when x satisfies the
    features in one bit mask and z those in the other; zero unless x and z together satisfy all of them."""
    out = np.zeros((1 << k, 1 << k, k))
    full = (1 << k) - 1
    for mx in range(1 << k):
        for mz in range(1 << k):
            if mx | mz != full:
                continue
            a, b = bin(mx & ~mz).count("1"), bin(mz & ~mx).count("1")
            for j in range(k):
                if mx >> j & 1 and not mz >> j & 1:
                    out[mx, mz, j] = math.factorial(a - 1) * math.factorial(b) / math.factorial(a + b)
                elif mz >> j & 1 and not mx >> j & 1:
                    out[mx, mz, j] = -math.factorial(a) * math.factorial(b - 1) / math.factorial(a + b)
    return out


def _masks(X: np.ndarray, leaf) -> np.ndarray:
    feats, lo, hi, _ = leaf
    sub = X[:, feats]
    return ((sub > lo) & (sub <= hi)) @ (1 << np.arange(len(feats)))


def shapley(leaves, X: np.ndarray, Z: np.ndarray) -> np.ndarray:
    """Mean over the background ``Z`` of the interventional Shapley values, for all rows of ``X`` at once.
    Rows and background rows only matter to a leaf through their masks, so the background is counted by mask."""
    phi = np.zeros(X.shape)
    for leaf in leaves:
        k = len(leaf[0])
        if k == 0:
            continue
        counts = np.bincount(_masks(Z, leaf), minlength=1 << k) / len(Z)
        by_mask = np.einsum("z,xzf->xf", counts, _share(k)) * leaf[3]
        phi[:, leaf[0]] += by_mask[_masks(X, leaf)]
    return phi


def margins(leaves, X: np.ndarray) -> np.ndarray:
    """The ensemble's output for each row."""
    out = np.zeros(len(X))
    for leaf in leaves:
        k = len(leaf[0])
        out += leaf[3] * (_masks(X, leaf) == (1 << k) - 1) if k else leaf[3]
    return out


def attributions(model: BoostedModel, foreground: DataFrame, background: DataFrame, features: Sequence[str],
                 key: str = "npi") -> DataFrame:
    """Per foreground row: ``i_<feature>`` (contribution to the log-odds),
    ``v_<feature>`` (the value), ``base_value`` and ``log_odds``."""
    feats = list(features)
    spark = foreground.sparkSession
    ship_package(spark)
    bg = background.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in feats]).toPandas()
    Z = bg.to_numpy("float64")                          # bounded: the background sample size
    leaves = leaves_of(model.node_tables(), [1.0] * len(model.trees))
    base = float(margins(leaves, Z).mean()) if len(Z) else 0.0
    bc = spark.sparkContext.broadcast((leaves, Z))

    def run(batches):
        own, Zb = bc.value
        for pdf in batches:
            X = pdf[feats].fillna(0.0).to_numpy("float64")
            res = pd.DataFrame(shapley(own, X, Zb), columns=[f"i_{c}" for c in feats])
            for j, c in enumerate(feats):
                res[f"v_{c}"] = X[:, j]
            res.insert(0, key, pdf[key].to_numpy())
            res["base_value"] = base
            res["log_odds"] = margins(own, X)
            yield res

    schema = (f"{key} string, " + ", ".join(f"i_{c} double" for c in feats) + ", "
              + ", ".join(f"v_{c} double" for c in feats) + ", base_value double, log_odds double")
    fg = foreground.select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in feats])
    return fg.repartition(foreground_partitions(foreground.count()), key).mapInPandas(run, schema)


def foreground_partitions(rows: int) -> int:
    """Tasks for the foreground: sized by its rows, whatever the session's shuffle partitions."""
    return max(1, -(-rows // ROWS_PER_TASK))


def background_sample(matrix: DataFrame, n: int = N_BACKGROUND, key: str = "npi") -> DataFrame:
    """Fixed-size reproducible background rows (hash order)."""
    return sample_fixed(matrix, n, key)
