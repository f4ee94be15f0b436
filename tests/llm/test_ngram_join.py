"""Operator 5 against all pairs."""

import random

import numpy as np
import pytest

from llm_helpers import duck, rows_of, words
from peerscope.llm import ngram_join as J
from peerscope.llm.graph import components


@pytest.mark.parametrize("threshold", [0.9, 0.8])
def test_linked_sets_share_a_key(threshold):
    rng, classes, t = np.random.default_rng(1), J.Classes(threshold), round(100 * threshold)
    linked = 0
    for _ in range(1500):
        n = int(rng.integers(classes.first, 60)) if rng.random() < 0.7 else int(rng.integers(60, 3000))
        s = np.unique(rng.integers(0, 2**63, size=n).astype(np.uint64))
        change = int(rng.integers(0, classes.differ(n) + 2))
        gone = int(rng.integers(0, change + 1))
        o = np.unique(np.concatenate([s[rng.permutation(s.size)[gone:]], rng.integers(0, 2**63, size=change - gone).astype(np.uint64)]))
        i = np.intersect1d(s, o).size
        if 100 * i >= t * (s.size + o.size - i):
            linked += 1
            assert s.size == o.size == i or np.intersect1d(classes.keys(s), classes.keys(o)).size
            # whichever keys count as common
            both = np.concatenate((classes.keys(s), classes.keys(o)))
            known = np.unique(both[rng.random(both.size) < rng.random()])
            common = known, rng.integers(1, 4, known.size)
            assert s.size == o.size == i or np.intersect1d(classes.keys(s, common), classes.keys(o, common)).size
    assert linked > 800


def test_empty_parts_are_covered():
    classes = J.Classes()
    many = np.random.default_rng(3).integers(0, 2**63, 400).astype(np.uint64)
    crowded = np.sort(many[J.mix64(many ^ J._B) >> np.uint64(62) == 2][:9])       # nine hashes in one of the four parts
    assert classes.parts(0) == 4 and classes.keys(crowded).size == 4      # empty parts have keys as well
    assert classes.keys(np.sort(many[:9])).size < 5


def _random_docs(r):
    docs = {}
    for k in range(r.randrange(5, 40)):
        if docs and r.random() < 0.7:
            w = r.choice(list(docs.values())).split()
            for _ in range(r.randrange(0, 4)):
                if w:
                    w[r.randrange(len(w))] = f"x{r.randrange(99)}"
            docs[k] = " ".join(w[:-2] if r.random() < 0.3 else w)
        else:
            docs[k] = " ".join(f"w{r.randrange(r.choice([5, 60]))}" for _ in range(r.choice([0, 1, 2, 5, 12, 40, 80, 150])))
    return docs


@pytest.mark.parametrize("seed", range(12))
def test_tree_join_finds_the_components(seed):
    docs = _random_docs(random.Random(seed))
    want = J.brute_force(docs)
    ids = [k for k in docs if want[k][0]]
    sets = [J.ngram_set(docs[k].encode()) for k in ids]
    assert [s.size for s in sets] == [want[k][0] for k in ids]
    half = len(ids) // 2
    found = [x for a, b in ((slice(half), slice(half)), (slice(half), slice(half, None)), (slice(half, None), slice(half, None)))
             for x in J.links(ids[a], sets[a], ids[b], sets[b])]
    label = {k: k for k in docs}
    for _ in ids:
        for a, b in found:
            label[a] = label[b] = min(label[a], label[b])
    assert label == {k: v[1] for k, v in want.items()}


def test_bound_is_no_less_than_the_intersection():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(120)]
    sets += [np.unique(rng.integers(0, 9000, k).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for k in (700, 900, 1500, 4000, 9000)]
    v = J.points_of(sets)
    assert len(set(v.groups.tolist())) > 2
    for a in range(0, 125, 4):
        for b in range(125):
            same = np.intersect1d(sets[a], sets[b]).size
            for g in (64, int(min(v.groups[a], v.groups[b]))):
                assert np.minimum(v.at(g, np.array([a])), v.at(g, np.array([b]))).sum() >= same
            if same >= J._need(sets[a].size, sets[b].size):
                assert v.near(a, v, np.array([b]), 0.9).size == 1


@pytest.mark.parametrize("tile", [1024, 3])
def test_edges_on_spark(spark, edge_docs, edge_rows, no_docs, tile, monkeypatch):
    monkeypatch.setattr(J, "TILE_ROWS", tile)
    monkeypatch.setattr(J, "POINT_ROWS", tile)
    monkeypatch.setattr(J, "BUCKET_HASHES", 500)
    base = words(200).split()
    chain = [(100 + k, " ".join(base[:k * 4] + [f"y{j}" for j in range(k * 4)] + base[k * 4:])) for k in range(8)]     # neighbours are linked
    chain += [(200 + k, " ".join([*base[:150 + k], *words(40, 900 + 50 * k).split()])) for k in range(8)]
    docs = edge_docs.select("doc_id", "text", "key", "node", "block").unionByName(
        spark.createDataFrame(chain, "doc_id long, text string").selectExpr("*", "'k' as key", "'n' as node", "'b' as block"))
    got = J.jaccard_components(docs).collect()
    rows = [x[:2] for x in edge_rows] + chain
    want = J.brute_force({d: t for d, t in rows if d is not None})
    sizes = {t: J.ngram_set((t or "").encode()).size for _, t in rows}
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(
        ((d, sizes[t], want[d][1] if d is not None else None) for d, t in rows), key=str)
    assert J.jaccard_components(no_docs).count() == 0


@pytest.mark.parametrize("threshold", [0.9, 0.8])
def test_tiles_hold_every_pair_that_may_link(spark, threshold):
    r = random.Random(6)
    rows = [(k, 1, r.choice([9, 10, 12, 50, 63, 80, 100, 125, 1000, 1250])) for k in range(60)] + [(100 + k, 2, 5 + 9 * k) for k in range(3)]
    got = J._tiles(spark.createDataFrame(rows, "rep long, block long, n_shingles long"), threshold, 4).collect()
    tiles = {}
    for g in got:
        tiles.setdefault((g.block, g.i, g.j), {False: set(), True: set()})[g.side].add(g.rep)
    assert all(len(t[False]) + len(t[True]) < 40 for t in tiles.values())
    met = set()
    for (_, i, j), t in tiles.items():
        met |= {frozenset((a, b)) for a in t[False] for b in (t[False] if i == j else t[True])}
    for a, block, n in rows:
        for b, other, m in rows:
            if block == other and 100 * min(n, m) >= round(100 * threshold) * max(n, m):
                assert frozenset((a, b)) in met
    assert sum(g.block == 2 for g in got) == 3


def test_one_of_each_group_stays(spark, edge_docs, edge_rows):
    got = J.one_of_each(edge_docs)
    assert got.columns == edge_docs.columns
    ids = sorted((r.doc_id for r in got.collect()), key=str)
    want = J.brute_force({r[0]: r[1] for r in edge_rows if r[0] is not None})
    assert ids == sorted([k for k, v in want.items() if v[1] == k] + [None, None], key=str)


def test_sql(docs):
    got = rows_of(J.jaccard_components(docs))
    assert got == duck(J.ORACLE_SQL, documents=docs.toPandas())
    assert any(r[0] != r[1] for r in got)


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 200 + k) for k in range(50)] + [(7, 7), (500, 499), (499, 500)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{k: 0 for k in range(41)}, 100: 100, **{200 + k: 100 for k in range(50)}, 499: 499, 500: 499}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _label(edges, nodes):
    """{node: smallest node of its component} by repeated passes."""
    label, changed = {n: n for n in nodes}, True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("seed", range(6))
def test_edges_of_a_flush_and_of_a_task_are_forests(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(J, "STATE_IDS", int(rng.choice([10, 1_000_000])))
    known, sent, pairs = J._Roots(), [], []
    for step in range(6):
        keys = rng.integers(0, 60, 90).astype(np.uint64)
        ids = rng.integers(0, 400, 90)
        more = rng.integers(0, 400, (5, 2))
        own, pivot, edges = J._forest(keys, ids, more)
        here = _label([(int(k) + 1000, int(i)) for k, i in zip(keys, ids)] + more.tolist(), [*range(400), *range(1000, 1060)])
        assert dict(edges.tolist()) == {n: here[n] for n in {*ids.tolist(), *more.ravel().tolist()} if here[n] != n}
        assert dict(zip(own.tolist(), pivot.tolist())) == {int(k): here[int(k) + 1000] for k in keys}
        new = known.add(keys, ids, more)
        sent += new.tolist()
        # the same key in another bucket is another key
        pairs += [(int(k) + 1000 * (step + 1), int(i)) for k, i in zip(keys, ids)] + [tuple(e) for e in more.tolist()]
    nodes = {n for p in pairs for n in p} | set(range(400))
    got = _label(sent, range(400))
    want = _label(pairs, nodes)
    assert [got[n] for n in range(400)] == [want[n] if want[n] < 400 else got[n] for n in range(400)]
    if J.STATE_IDS > 10:
        assert len(sent) == 400 - len(set(got.values()))


def test_no_forest_of_nothing():
    none = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros((0, 2), dtype=np.int64)
    assert all(not len(x) for x in J._forest(*none)) and not len(J._Roots().add(*none))


def test_edges_do_not_grow_with_the_tasks(spark, monkeypatch):
    """Texts that share most of their keys meet in every task, but not every task sends their edges."""
    monkeypatch.setattr(J, "BUCKET_HASHES", 200)
    sent, real = [], J.components
    monkeypatch.setattr(J, "components", lambda edges: sent.append(edges.count()) or real(edges))
    rows = []
    for g in range(20):
        base = words(200, 1000 * g).split()
        rows += [(100 * g + k, " ".join([*base[:9 * k], f"x{g}y{k}", *base[9 * k + 1:]])) for k in range(8)]
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = {r.doc_id: r.component_id for r in J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert got == {d: d // 100 * 100 for d, _ in rows}
    assert sum(sent) < 10 * len(rows) and max(sent) <= J.FIRST_KEYS * len(rows)
