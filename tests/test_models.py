import hashlib
import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from peerscope.models import boost as B
from peerscope.models import explain as X
from peerscope.models import isolation as I
from peerscope.models import smote as SM


def _points(spark, n=120, d=5, seed=3, label_every=4):
    rng = np.random.default_rng(seed)
    X_ = rng.normal(size=(n, d)) * np.array([1000.0, 1.0, 10.0, 0.1, 5.0][:d])
    X_[:5] += 50000.0                                  # a few far outliers
    feats = [f"f{i}" for i in range(d)]
    pdf = pd.DataFrame(X_, columns=feats)
    pdf.insert(0, "npi", [f"1{i:09d}" for i in range(n)])
    pdf["is_fraud_label"] = [int(i % label_every == 0) for i in range(n)]
    return spark.createDataFrame(pdf), pdf, feats


def test_isolation_scores_range_determinism_and_outliers(spark):
    df, pdf, feats = _points(spark)
    a = I.isolation_scores(df, feats, n_trees=30, max_samples=64).toPandas().set_index("npi").fraud_score_iso
    b = I.isolation_scores(df, feats, n_trees=30, max_samples=64).toPandas().set_index("npi").fraud_score_iso
    assert a.min() == 0.0 and a.max() == 1.0
    assert (a.sort_index() == b.sort_index()).all()                  # reproducible
    outliers = [f"1{i:09d}" for i in range(5)]
    assert a[outliers].mean() > a.drop(outliers).mean()


def test_average_path_length():
    assert list(I.average_path_length(np.array([0, 1, 2]))) == [0.0, 0.0, 1.0]
    assert abs(float(I.average_path_length(np.array([256]))[0]) - 10.244770920116851) < 1e-9


def test_knn_exact_against_brute_force(spark):
    df, pdf, feats = _points(spark, n=80)
    knn = SM.minority_knn(df, feats, k=5).toPandas()
    Xv = pdf[feats].to_numpy()
    keys = pdf.npi.tolist()
    for i, key in enumerate(keys):
        d = np.sqrt(((Xv - Xv[i]) ** 2).sum(axis=1))
        want = sorted((d[j], keys[j]) for j in range(len(keys)) if j != i)[:5]
        got = knn[knn.npi == key].sort_values("nn_rank")
        assert got.nn_key.tolist() == [w[1] for w in want]


def test_smote_balances_and_interpolates(spark):
    df, pdf, feats = _points(spark, n=60)
    syn = SM.smote(df, feats).toPandas()
    n1 = int(pdf.is_fraud_label.sum())
    assert len(syn) == len(pdf) - 2 * n1 and (syn.is_fraud_label == 1).all()
    mino = pdf[pdf.is_fraud_label == 1][feats].to_numpy()
    lo, hi = mino.min(axis=0), mino.max(axis=0)
    assert ((syn[feats].to_numpy() >= lo - 1e-9) & (syn[feats].to_numpy() <= hi + 1e-9)).all()


def test_gbt_attributions_are_additive(spark):
    df, pdf, feats = _points(spark, n=100, label_every=3)
    p = B.BoostParams(n_trees=3, max_depth=3, oversample=False)
    model = B.fit(df, feats, params=p)
    fg = df.orderBy("npi").limit(6)
    bg = X.background_sample(df, 10)
    att = X.attributions(model, fg, bg, feats).toPandas()
    contrib = att[[f"i_{c}" for c in feats]].sum(axis=1)
    assert np.allclose(contrib, att.log_odds - att.base_value, atol=1e-9)
    # log-odds agree with the probability: p = sigmoid(log_odds)
    prob = B.predict(model, fg).toPandas().set_index("npi").fraud_score_xgb
    assert np.allclose(1 / (1 + np.exp(-att.set_index("npi").log_odds)), prob.loc[att.npi].to_numpy(), atol=1e-9)


def _same(a, b):
    return len(a.trees) == len(b.trees) and all((x == y).all() for s, t in zip(a.trees, b.trees) for x, y in zip(s, t))


@pytest.mark.parametrize("rows_in_task", [B.ROWS_IN_TASK, 10])
def test_boosting_finds_the_signal_and_both_ways_agree(spark, rows_in_task):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 4))
    pdf = pd.DataFrame(x, columns=["a", "b", "c", "d"])
    pdf.insert(0, "npi", [f"1{i:09d}" for i in range(600)])
    pdf["is_fraud_label"] = ((x[:, 0] * x[:, 1] > 0.4) | (x[:, 2] > 1.8)).astype(int)
    pdf.loc[5, "a"] = np.nan
    feats = ["a", "b", "c", "d"]
    p = B.BoostParams(n_trees=12 if rows_in_task > 10 else 3, max_depth=4, learning_rate=0.3, oversample=False, rows_in_task=rows_in_task)
    oof, model = B.fit_all(spark.createDataFrame(pdf).repartition(3), feats, params=p)
    got = oof.toPandas().set_index("npi")
    assert len(got) == 600 and got.fraud_score_xgb.between(0, 1).all()
    # the same on another number of partitions, and with the other way to train
    again, other = B.fit_all(spark.createDataFrame(pdf).repartition(7), feats, params=B.BoostParams(**{**p.__dict__, "rows_in_task": 5000}))
    assert _same(model, other)
    assert (again.toPandas().set_index("npi").loc[got.index].fraud_score_xgb == got.fraud_score_xgb).all()
    if rows_in_task > 10:
        y = pdf.set_index("npi").is_fraud_label.loc[got.index]
        assert got.fraud_score_xgb[y == 1].mean() > 0.75 > 0.25 > got.fraud_score_xgb[y == 0].mean()
        alone = B.fit(spark.createDataFrame(pdf), feats, params=p)
        assert _same(model, alone)


def test_boosting_equals_a_plain_tree():
    """One round of one tree against sums over all cuts."""
    rng = np.random.default_rng(6)
    b = rng.integers(0, 9, (80, 3)).astype(np.uint8)
    y = (rng.random(80) < 0.4).astype(float)
    p = B.BoostParams(n_trees=1, max_depth=1, subsample=1.0, feature_subset=1.0)
    feature, cut, value = B._train_in_task(b, y, np.ones(80), np.arange(80), 0, 9, p)[0]
    g, h = 0.5 - y, np.full(80, 0.25)

    def gain(mask):
        if h[mask].sum() < 1 or h[~mask].sum() < 1:
            return -1.0
        return sum(g[m].sum() ** 2 / (h[m].sum() + 1) for m in (mask, ~mask)) - g.sum() ** 2 / (h.sum() + 1)

    best = max(((gain(b[:, f] <= c), -f, -c) for f in range(3) for c in range(8)))
    assert (feature[0], cut[0]) == (-best[1], -best[2])
    left = b[:, feature[0]] <= cut[0]
    assert np.allclose(value[1:3], [-0.05 * g[m].sum() / (h[m].sum() + 1) for m in (left, ~left)], atol=1e-6)


def test_boosting_sums_only_the_smaller_children(monkeypatch):
    """A level of a tree reads at most half of the rows; the trees are those of sums over all rows."""
    rng = np.random.default_rng(8)
    b = rng.integers(0, 40, (3000, 6)).astype(np.uint8)
    y = (rng.random(3000) < b[:, 0] / 40).astype(float)
    weight, h, p = np.where(y == 1, 3.0, 1.0), np.arange(3000), B.BoostParams(n_trees=3, max_depth=4, subsample=0.7)
    read, real = [], B._sums_of
    monkeypatch.setattr(B, "_sums_of", lambda columns, rows, *rest: read.append(len(rows) * len(columns)) or real(columns, rows, *rest))
    trees = B._train_in_task(b, y, weight, h, 1, 40, p)
    drawn = [int((B._draw(h, p.seed, 1, k, 1) < p.subsample).sum()) for k in range(3)]
    used = max(1, int(p.feature_subset * 6))
    assert sum(drawn) * used <= sum(read) <= sum(drawn) * used * (1 + (p.max_depth - 1) / 2)

    margin, want = np.zeros(3000), []
    for k in range(3):
        g, hess = B._derivatives(margin, y, weight)
        rows = np.flatnonzero(B._draw(h, p.seed, 1, k, 1) < p.subsample)
        tree, nodes = B._empty(p.max_depth), [0]
        while nodes:
            sums = B._histograms(b[rows], g[rows], hess[rows], B._places(tree, b[rows]), np.array(nodes), 40)
            nodes = B._grow(tree, nodes, B._cuts(sums), B._columns(6, p, 1, k), p)
        want.append(tree)
        margin += B._values(tree, b)
    assert all((x == y).all() for s, t in zip(trees, want) for x, y in zip(s, t))


def test_features_are_summed_over_joint_bins(monkeypatch):
    """Several features in one pass over the rows; the trees are those of one feature at a time."""
    rng = np.random.default_rng(9)
    b = np.stack([rng.integers(0, n, 3000) for n in (2, 2, 2, 3, 5, 16, 16, 16)], 1).astype(np.uint8)
    y = (rng.random(3000) < b[:, 5] / 16).astype(float)
    p, calls, real = B.BoostParams(n_trees=3, max_depth=4), [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **kw: calls.append(1) or real(*a, **kw))
    trees = {}
    for most in (1 << 16, 256):
        monkeypatch.setattr(B, "JOINT_BINS", most)
        trees[most], n = B._train_in_task(b, y, np.ones(3000), np.arange(3000), 1, 16, p), len(calls)
        calls.clear()
        if most == 256:
            assert n < before / 2
        before = n
    assert all((x == y).all() for s, t in zip(*trees.values()) for x, y in zip(s, t))
    assert B._packed([256, 2, 256, 3], 1 << 16) == [[1, 3, 0], [2]]


def test_rows_that_were_not_drawn_are_led_by_columns(monkeypatch):
    """Only the columns that a node cuts are read for the rows a tree has not drawn; no matrix of those rows is made."""
    rng = np.random.default_rng(4)
    b = rng.integers(0, 16, (4000, 6)).astype(np.uint8)
    y = (rng.random(4000) < (b[:, 1] * b[:, 4]) / 225).astype(float)
    p = B.BoostParams(n_trees=4, max_depth=4)
    by_rows = B._places
    monkeypatch.setattr(B, "_places", None)
    trees = B._train_in_task(b, y, np.ones(4000), np.arange(4000), 1, 16, p)
    columns, rows = np.ascontiguousarray(b.T), np.sort(rng.choice(4000, 700, replace=False))
    assert all((B._ends_of(t, columns, rows) == by_rows(t, b[rows])).all() for t in trees) and any((t[0] >= 0).sum() > 4 for t in trees)
    assert B._ends_of(trees[0], columns, rows[:0]).size == 0


def test_derivatives_to_the_last_bit():
    rng = np.random.default_rng(8)
    m, y, w = rng.normal(0, 4, 5000), rng.integers(0, 2, 5000).astype(float), np.where(rng.random(5000) < 0.5, 1.0, 1.2507)
    m[:3] = 0.0, 800.0, -800.0
    with np.errstate(over="ignore"):
        prob = 1.0 / (1.0 + np.exp(-m))
        want = np.rint(B.UNIT * w * (prob - y)), np.rint(B.UNIT * w * prob * (1.0 - prob))
        kept = m.copy(), w.copy()
        got = B._derivatives(m, y, w)
    assert all((a == b).all() for a, b in zip(got, want)) and (m == kept[0]).all() and (w == kept[1]).all()


def test_edges_sort_few_rows_and_take_the_least_hashes(spark, monkeypatch):
    """Of many rows only those of small hash are sorted in one task; the sample is that of all rows, null and repeated keys included."""
    monkeypatch.setattr(B, "BIN_SAMPLE", 40)
    keys = [None, None] + [f"k{i}" for i in range(400)] + ["k1", "k1"]
    rows = spark.createDataFrame([(k, float(i)) for i, k in enumerate(keys)], "npi string, x double")
    sorted_rows, real = [], type(rows).orderBy
    monkeypatch.setattr(type(rows), "orderBy", lambda self, *a, **kw: sorted_rows.append(self.count()) or real(self, *a, **kw))
    edges = B.bin_edges(rows, ["x"], "npi", 256)[0]
    own = sorted((int(hashlib.md5(k.encode()).hexdigest()[:8], 16) if k is not None else -1, k or "", float(i)) for i, k in enumerate(keys))
    x = np.unique([v for _, _, v in own[:40]])
    assert edges.tolist() == ((x[:-1] + x[1:]) / 2).tolist() and sorted_rows and sorted_rows[0] < 150


def test_a_million_rows_take_one_job(spark, monkeypatch):
    """Only above millions of rows a model is there a job a level, thousands of them."""
    assert B.BoostParams().rows_in_task >= 1_000_000
    col = pa.chunked_array([pa.array([b"\1\2", b"\3\4", b"\5\6"], pa.binary()).slice(1), pa.array([b"\7\0"], pa.binary())])
    assert B._bytes(col, 2).tolist() == [[3, 4], [5, 6], [7, 0]]
    assert B._bytes(pa.chunked_array([], pa.binary()), 2).shape == (0, 2)


def test_boosting_edges(spark):
    schema = "npi string, a double, b double, is_fraud_label int"
    none = spark.createDataFrame([], schema)
    one = spark.createDataFrame([(f"{k}", 1.0, None, 0) for k in range(20)], schema)       # one class, equal and null features
    p = B.BoostParams(n_trees=2, max_depth=2, oversample=False)
    assert B.fit_all(none, ["a", "b"], params=p)[0].count() == 0
    scores, model = B.fit_all(one, ["a", "b"], params=p)
    assert scores.count() == 20 and all((t[0] == -1).all() for t in model.trees)


def test_model_folder_scores_like_the_run(spark, tmp_path):
    df, pdf, feats = _points(spark, n=90, label_every=3)
    model = B.fit(df, feats, params=B.BoostParams(n_trees=4, max_depth=3, oversample=False))
    B.save_model(model, str(tmp_path / "m"), spark, threshold=0.25)
    back, settings = B.load_model(str(tmp_path / "m"), spark)
    assert settings == {"threshold": 0.25} and back.features == feats and _same(model, back)
    assert sorted(B.predict(back, df).collect()) == sorted(B.predict(model, df).collect())


def _by_definition(leaves, x, z):
    """Shapley values of the set function "features in S follow x, the others z", over all orders."""
    n = len(x)
    value = {}
    for size in range(n + 1):
        for chosen in itertools.combinations(range(n), size):
            mixed = z.copy()
            mixed[list(chosen)] = x[list(chosen)]
            value[frozenset(chosen)] = X.margins(leaves, mixed[None])[0]
    phi = np.zeros(n)
    for order in itertools.permutations(range(n)):
        before = frozenset()
        for f in order:
            phi[f] += value[before | {f}] - value[before]
            before = before | {f}
    return phi / math.factorial(n)


def test_shapley_of_a_stump():
    # stump on feature 0 at 0.5: left 1.0, right 3.0
    tree = (np.array([0, -1, -1]), np.array([0.5, 0, 0]), np.array([1, -1, -1]), np.array([2, -1, -1]),
            np.array([0.0, 1.0, 3.0]))
    leaves = X.leaves_of([tree], [1.0])
    assert X.shapley(leaves, np.array([[1.0, 0.0]]), np.array([[0.0, 0.0]])).tolist() == [[2.0, 0.0]]


def test_shapley_equals_the_definition():
    rng = np.random.default_rng(0)
    fe = np.array([0, 1, 2, -1, -1, 1, -1, 0, -1, -1, -1])
    th = np.array([0.0, 0.5, -0.2, 0, 0, -0.3, 0, -0.7, 0, 0, 0])
    le = np.array([1, 3, 5, -1, -1, 7, -1, 9, -1, -1, -1])
    ri = np.array([2, 4, 6, -1, -1, 8, -1, 10, -1, -1, -1])
    va = np.array([0, 0, 0, 1.0, -2.0, 0, 0.5, 3.0, -1.5, 0.25, 4.0])
    tree = (fe, th, le, ri, va)
    leaves = X.leaves_of([tree, tree], [1.0, -0.3])
    Xr, Z = rng.normal(size=(12, 4)), rng.normal(size=(9, 4))
    Z[0] = Xr[0]
    got = X.shapley(leaves, Xr, Z)
    want = [np.mean([_by_definition(leaves, x, z) for z in Z], axis=0) for x in Xr]
    assert np.allclose(got, want)
    assert np.allclose(got.sum(1), X.margins(leaves, Xr) - X.margins(leaves, Z).mean())


def test_attribution_tasks_follow_the_foreground():
    assert [X.foreground_partitions(n) for n in (0, 1, 64, 65, 500)] == [1, 1, 1, 2, 8]


def test_smote_needs_enough_minority_rows(spark):
    df, pdf, feats = _points(spark, n=20, label_every=5)        # four minority rows
    with pytest.raises(ValueError):
        SM.smote(df, feats)
    assert SM.smote(df, feats, few="shrink").count() == 20 - 2 * 4


def _neighbours(pdf, feats, k, allowed=None):
    """{key: [(distance, key)]} by comparing all rows."""
    x, keys = pdf[feats].fillna(0).to_numpy(), pdf.npi.tolist()
    out = {}
    for i, key in enumerate(keys):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        out[key] = sorted((d[j], keys[j]) for j in range(len(keys)) if j != i and (allowed is None or allowed[j]))[:k]
    return out


@pytest.mark.parametrize("chunk, cell", [(2048, 64), (3, 4)])
def test_knn_by_cells_chunks_and_folds(spark, monkeypatch, chunk, cell):
    monkeypatch.setattr(SM, "CHUNK", chunk)
    monkeypatch.setattr(SM, "CELL_ROWS", cell)
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(90, 3)) * [100, 1, 1], 1)
    x[:25] = x[0]                                                   # a hot vector, in all folds
    pdf = pd.DataFrame(x, columns=["a", "b", "c"])
    pdf.loc[40:44, "c"] = np.nan
    pdf.insert(0, "npi", [f"1{(i * 37) % 1000:09d}" for i in range(90)])
    pdf["fold"] = [i % 3 + 1 for i in range(90)]
    df = spark.createDataFrame(pdf).repartition(4)
    df = df.select("npi", "fold", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in "abc"])
    knn = SM.minority_knn(df, ["a", "b", "c"], k=4, group="fold")
    for fold in (None, 1, 3):
        got = SM.neighbours_outside(knn, df, fold, k=4).toPandas()
        outside = pdf.fold != (fold or 0)
        want = _neighbours(pdf, ["a", "b", "c"], 4, outside.tolist())
        rows = {key: [r.nn_key for r in g.sort_values("nn_rank").itertuples()] for key, g in got.groupby("npi")}
        assert rows == {key: [w[1] for w in want[key]] for key in pdf.npi[outside]}


def test_knn_of_equal_rows_and_of_few(spark):
    rows = [(f"k{i:03d}", 1.0) for i in range(200)]
    knn = SM.minority_knn(spark.createDataFrame(rows, "npi string, a double"), ["a"], k=3).toPandas()
    assert len(knn) == 600 and (knn.dist == 0).all()
    assert knn[knn.npi == "k150"].sort_values("nn_rank").nn_key.tolist() == ["k000", "k001", "k002"]
    assert knn[knn.npi == "k001"].sort_values("nn_rank").nn_key.tolist() == ["k000", "k002", "k003"]
    two = spark.createDataFrame(rows[:2], "npi string, a double")
    assert SM.minority_knn(two, ["a"]).count() == 2 and SM.minority_knn(two.limit(1), ["a"]).count() == 0
    assert SM.minority_knn(two.limit(0), ["a"]).count() == 0


def test_isolation_samples_are_the_smallest_hashes(spark):
    df, pdf, feats = _points(spark, n=90)
    nodes, psi = I.grow_forest(df, feats, n_trees=12, max_samples=16)
    keys = pdf.npi.tolist()
    hashed = [int(hashlib.md5(k.encode()).hexdigest()[:8], 16) % I.PRIME for k in keys]
    got = nodes.toPandas()
    assert psi == 16 and (got.node == 1).sum() == 12
    assert (got[got.feature < 0].groupby("tree")["size"].sum() == 16).all(), got
    X_ = pdf[feats].to_numpy()
    for tree in range(12):
        a, b = I.tree_draws(I.SEED, tree)
        own = X_[sorted(range(len(keys)), key=lambda i: ((a * hashed[i] + b) % I.PRIME, keys[i]))[:16]]
        root = got[(got.tree == tree) & (got.node == 1)].iloc[0]
        left = got[(got.tree == tree) & (got.node == 2)].iloc[0]
        assert left["size"] == (own[:, int(root.feature)] <= root.threshold).sum()


def test_isolation_scores_do_not_depend_on_partitions(spark):
    df, _, feats = _points(spark, n=90)
    one, many = ({r["npi"]: r["fraud_score_iso"] for r in I.isolation_scores(df.repartition(k), feats, n_trees=10, max_samples=16).collect()}
                 for k in (1, 7))
    assert one == many


def test_isolation_of_equal_rows_and_few_rows(spark):
    same = spark.createDataFrame([(f"k{i}", 1.0) for i in range(6)], "npi string, a double")
    nodes, psi = I.grow_forest(same, ["a"], n_trees=3)
    assert psi == 6 and sorted((r["node"], r["feature"], r["size"]) for r in nodes.collect()) == [(1, -1, 6)] * 3


def test_knn_exact_with_duplicates_and_clusters(spark):
    rng = np.random.default_rng(9)
    pts = np.vstack([np.zeros((30, 3)), rng.normal(size=(40, 3)) * 1e-6 + 5.0, rng.normal(size=(30, 3)) * 100])
    pdf = pd.DataFrame(pts, columns=["a", "b", "c"])
    pdf.insert(0, "npi", [f"1{i:09d}" for i in range(len(pdf))])
    knn = SM.minority_knn(spark.createDataFrame(pdf), ["a", "b", "c"], k=5).toPandas()
    Xv = pdf[["a", "b", "c"]].to_numpy()
    keys = pdf.npi.tolist()
    assert len(knn) == 5 * len(pdf)
    for i, key in enumerate(keys):
        d = np.sqrt(((Xv - Xv[i]) ** 2).sum(axis=1))
        want = sorted((d[j], keys[j]) for j in range(len(keys)) if j != i)[:5]
        got = knn[knn.npi == key].sort_values("nn_rank")
        assert got.nn_key.tolist() == [w[1] for w in want], key
