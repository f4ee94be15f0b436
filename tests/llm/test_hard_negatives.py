"""Operator 13."""

import math
import random

import numpy as np
import pytest

from llm_helpers import duck, rows_of
from peerscope.llm import hard_negatives as H

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int"


def by_hand(rows, positives=5, negatives=10):
    """The contract over all pairs."""
    own = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v])
        own[i] = min(own.get(i, row), row)
    out = []
    for a, (label, q) in own.items():
        if a % 100:
            continue
        s = sorted((-max(-2 ** 63 + 1, min(2 ** 63 - 1, sum(x * y for x, y in zip(q, r)))), i, o) for i, (o, r) in own.items() if i != a)
        for p, i, _ in [x for x in s if x[2] == label][:positives]:
            hits = [x for x in s if x[2] != label and 30 * -p <= 100 * -x[0] <= 90 * -p][:negatives]
            out += [(a, i, k + 1, j, -p, -n) for k, (n, j, _) in enumerate(hits)]
    return sorted(out)


def got(df, **kw):
    return sorted(tuple(r) for r in H.mine(df, **kw).collect())


def random_rows(n, seed, dim=6, labels=4, step=25):
    r = random.Random(seed)
    return [(k * step - 300, [r.randint(-20, 20) / 64 for _ in range(dim)], r.randrange(labels)) for k in range(n)]


def test_keys_sort_like_their_values():
    r = random.Random(1)
    some = [-(2 ** 63) + 1, 2 ** 63 - 1, 0, -1, 1, 5, -700, 2 ** 40]
    rows = [(r.choice(some), r.choice(some), r.randrange(2), r.choice(some)) for _ in range(300)]
    keys = [H._packed(np.array([a]), np.array([s]), k, np.array([i])).tobytes() for a, s, k, i in rows]
    assert [H.unpack(k) for k in keys] == rows
    assert [H.unpack(k) for k in sorted(keys)] == sorted(rows, key=lambda x: (x[0], -x[1], x[2], x[3]))


def test_best_is_exact_in_both_ways():
    r = np.random.default_rng(2)
    for top in (3, 1000, 1 << 62):
        s, valid = r.integers(-top, top, (20, 30)), r.random((20, 30)) < 0.4
        for k in (1, 5, 30, 40):
            at = H.best(s, valid, k)
            for i in range(20):
                want = sorted(np.flatnonzero(valid[i]).tolist(), key=lambda c: (-int(s[i, c]), c))[:k]
                assert sorted(c for c in at[i].tolist() if c >= 0) == sorted(want)


@pytest.mark.parametrize("seed", range(3))
def test_random_rows_equal_all_pairs(spark, seed):
    rows = random_rows(400, seed)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == by_hand(rows) != []


def test_more_than_one_pass(spark):
    rows = random_rows(500, 9, step=100)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df, per_pass=90) == by_hand(rows)


def test_small_tiles(spark, monkeypatch):
    rows = random_rows(200, 4)
    monkeypatch.setattr(H, "TILE_ROWS", 7)
    monkeypatch.setattr(H, "TILE_ANCHORS", 3)
    tiles = list(H._tiles(spark.createDataFrame(rows, SCHEMA).select("vec_id", "label", H.F.col("embedding").alias("q")).toArrow().to_batches()))
    assert max(len(t[0]) for t in tiles) == 7


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    same = [0.5, 0.25]
    rows = [(0, same, 1), (100, same, 1), (200, [0.0, 0.0], 1), (300, [-0.5, -0.25], 2), (400, [], 2), (500, [1.0], 3), (600, same, 7), (600, same, 7),
            (600, [9.0, 1.0], 7), (None, same, 1), (1, None, 1), (2, same, None), (3, [nan, 1.0], 1), (4, [None, 1.0], 1), (5, [inf, 1.0], 2), (None, None, None)]
    rows += [(k, same, k % 2) for k in range(1001, 1400)]                               # one vector hundreds of times
    rows += [(k, [0.25, 0.125], 3 + k % 2) for k in range(2001, 2300)]                  # and one within the windows
    rows += [(700, [1e14, 1e14], 5), (800, [1e14, 1e13], 5), (801, [6e13, 6e13], 6), (900, [1e300, 1.0], 5)]       # beyond 2^53
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("q", "pair", "score", "number", "positive_id", "r", "count", "p"):
        df = df.withColumn(c, H.F.lit("x"))
    want = [r for r in rows if r[0] != 900]
    assert got(df.where("vec_id <> 900 or vec_id is null").repartition(6)) == by_hand(want)
    assert H.mine(df).count() > 0                                                       # components beyond a long are held to it
    assert H.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert got(spark.createDataFrame([(100, [1.0], 1), (101, [0.5], 2)], SCHEMA)) == []  # no positives


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_table_equals_sql(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert rows_of(H.mine(df)) == duck(H.ORACLE_SQL, embeddings=df.toPandas())
