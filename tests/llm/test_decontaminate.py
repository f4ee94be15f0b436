"""Operator 3 against all windows compared one by one, and against its SQL."""

import hashlib
import random

import pytest

from peerscope.llm import decontaminate as D
from llm_helpers import duck, rows_of


@pytest.mark.parametrize("seed", range(60))
def test_automaton_finds_what_comparing_windows_finds(seed):
    r = random.Random(seed)
    size = r.choice([2, 3, 8, 30])
    word = lambda k: " ".join(f"w{r.randrange(size)}" for _ in range(k))
    items = [(i, word(r.choice([0, 1, 2, 3, 5, 9, 10, 11, 14, 20]))) for i in range(r.randrange(1, 8))]
    if r.random() < 0.5:
        items = [x for x in items if len(x[1].split()) >= 4]
    docs = [(i, word(r.randrange(0, 60)) + " " + (r.choice(items)[1] if items else "") + " " + word(r.randrange(0, 9))) for i in range(6)]
    window = r.choice([4, 10])
    sam = D.SuffixAutomaton([(i, D.words_of(t.encode())) for i, t in items], window)
    want = D.brute_force(docs, items, window)
    for i, t in docs:
        spans, found = sam.scan(D.words_of(t.encode()))
        assert ({p for a, b in spans for p in range(a, b)}, found) == want[i][1:]


ITEMS = [(1, "One two three four five six seven eight nine ten eleven."), (2, "short item"), (3, None), (4, ""), (5, "!!"),
         (6, "One two three four five six seven eight nine ten eleven."), (None, "w1 w2 w3 w4"), (2, "short item")]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def _want(rows):
    out = []
    for doc, text in rows:
        n, hit, found = D.brute_force([(0, text)], [x for x in ITEMS if x[0] is not None])[0]
        names = ",".join(sorted(map(str, found)))
        out.append((str(doc), n, len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("block", [D.MAX_BLOCK_WORDS, 8])
def test_edges_on_spark(spark, edge_docs, edge_rows, benchmark, block):
    more = [(20, "Zero ONE, two three-four five six seven eight nine ten eleven; twelve"), (21, "a Short\nITEM b short item")]
    docs = edge_docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = D.report(D.scan(docs, benchmark, max_block_words=block)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == _want(
        [x[:2] for x in edge_rows] + more)


def test_empty_tables(no_docs, docs, benchmark):
    assert D.report(D.scan(no_docs, benchmark)).count() == 0
    got = D.report(D.scan(docs, benchmark.limit(0)))
    assert got.where("contaminated or n_items > 0").count() == 0 and got.count() == docs.count()


def test_sql(spark, docs):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = rows_of(D.report(D.scan(docs, bench)))
    assert got == duck(D.ORACLE_SQL, documents=docs.toPandas(), benchmark=bench.toPandas())
    assert sum(r[0] for r in got) > 0


def test_removal_keeps_all_columns(spark, edge_docs, benchmark):
    clean = D.decontaminate(edge_docs, benchmark)
    assert clean.columns == edge_docs.columns and rows_of(clean) == rows_of(edge_docs)      # nothing is contaminated
    rows = [(1, "before " * 30 + "one two three four five six seven eight nine ten eleven after", 9), (2, "short item", 10), (3, "fine", 4)]
    got = D.decontaminate(spark.createDataFrame(rows, "doc_id long, text string, n_chars long"), benchmark).collect()
    assert {r.doc_id: (r.text, r.n_chars) for r in got} == {1: ("before " * 30 + " after", 216), 3: ("fine", 4)}
    got = D.decontaminate(spark.createDataFrame(rows, "doc_id long, text string, n_chars long"), benchmark, max_hit_words=5).collect()
    assert [r.doc_id for r in got] == [3]


@pytest.mark.parametrize("block", [D.MAX_BLOCK_WORDS, 8])
def test_passages_are_cut_by_the_step_that_finds_them(spark, benchmark, block):
    """One Python step: a second worker in every core is memory that the executor keeps."""
    rows = [(1, "before " * 30 + "one two three four five six seven eight nine ten eleven between short item after"), (2, "fine"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_words, len(r.hits)) for r in D.scan(docs, benchmark, max_block_words=block, cut=True).select("row.doc_id", "text", "n_words", "hits").collect()}
    assert got == {1: ("before " * 30 + " between  after", 45, 2), 2: ("fine", 1, 0), 3: (None, 0, 0), 4: ("", 0, 0)}
    assert {r.doc_id: r.text for r in D.scan(docs, benchmark, max_block_words=block).select("row.doc_id", "text").collect()} == dict(rows)
    plan = D.decontaminate(docs, benchmark)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
