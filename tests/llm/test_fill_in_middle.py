"""Operator 12."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_helpers import duck, rows_of
from peerscope.llm import fill_in_middle as FM

ALPHABET = st.sampled_from(list("abzAZ@[`{09 \n<>PSM\u0000\u007f\u0080éß日߿￿😀"))


def by_hand(doc_id, text):
    """The contract with regular expressions."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[k:k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(units)
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=6))
def test_unit_ends_by_rank(texts):
    units = FM.Units([t.encode() for t in texts])
    split = [re.findall(r"[A-Za-z]+|[^A-Za-z]", t) for t in texts]
    assert units.counts().tolist() == [len(u) for u in split]
    import numpy as np
    for rank in range(max(map(len, split)) + 1):
        ranks = np.array([min(rank, len(u)) for u in split])
        size, points = units.cut(ranks)
        heads = ["".join(u[:r]) for u, r in zip(split, ranks)]
        assert size.tolist() == [len(x.encode()) for x in heads] and points.tolist() == [len(x) for x in heads]


def test_edges_on_spark(edge_docs, edge_rows, no_docs):
    got = FM.transform(edge_docs).collect()
    key = lambda r: tuple(map(str, r))      # noqa: E731
    assert sorted((tuple(r) for r in got), key=key) == sorted((by_hand(r[0], r[1]) for r in edge_rows), key=key)
    back = sorted(x[0] for x in FM.transform(edge_docs).select(FM.restored()).collect())
    assert back == sorted(r[1] or "" for r in edge_rows)
    assert FM.digests(FM.transform(no_docs)).count() == 0


def test_marks_half_marks_and_long_runs(spark):
    texts = ["a <P> b", "<S>", "x<M", "<S<S", "P><P", "<<<<>>>>", "<P", "a" * 1_000_003, "é" * 500_001, "a1" * 300_000, "<" * 65_536]
    rows = [(k, texts[k % len(texts)]) for k in range(40 * len(texts))][::-1]
    rows = [r for r in rows if len(r[1]) < 100 or r[0] < 5 * len(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: tuple(r) for r in FM.transform(df).collect()}
    assert got == {d: by_hand(d, t) for d, t in rows}
    assert {g[2] for g in got.values()} == {"plain", "psm", "spm"}
    assert {r.doc_id: r.back for r in FM.transform(df).select("doc_id", FM.restored().alias("back")).collect()} == dict(rows)


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_table_equals_sql(docs, sf):
    assert rows_of(FM.digests(FM.transform(docs))) == duck(FM.ORACLE_SQL, documents=docs.toPandas())
