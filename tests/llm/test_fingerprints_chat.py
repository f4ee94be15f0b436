"""Operators 4 and 10."""

import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_helpers import duck, rows_of, words
from peerscope.llm import chat_format as C
from peerscope.llm import fingerprints as FP


def test_paragraphs_form_a_multiset():
    a, b = b"first line\nsecond\n\nthird line here", b"third line here\n\nsecond\nfirst line"
    assert FP.fingerprint(a) == FP.fingerprint(b) != FP.fingerprint(a + b"\nsecond")
    one, two = FP.fingerprint(b"alpha beta\nxyz"), FP.fingerprint(b"gamma delta epsilon")
    both = FP.fingerprint(b"gamma delta epsilon\nxyz\nalpha beta")
    assert FP.combine(one, two) == both and FP.combine(both, two, remove=True) == one
    assert FP.fingerprint(b"") == FP.combine(one, one, remove=True)


def _chain(rows):
    """Contract by hand: rows of (id, text) in falling order of id, ties by text."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [t or "" for _, t in order]
    out = []
    for (doc, _), here, after in zip(order, texts, texts[1:] + texts[:1]):
        n = len(here) // 2
        out.append((doc, len(here), here[:len(here) - n] + after[:n], here))
    return out


@pytest.mark.parametrize("per_range", [2, 4096])
def test_edges_on_spark(edge_docs, edge_rows, no_docs, per_range):
    got = FP.fingerprints(edge_docs, rows_per_range=per_range).collect()
    want = sorted((str(d), n, hashlib.sha256(e.encode()).hexdigest(), FP.fingerprint(t.encode()), FP.fingerprint(e.encode()))
                  for d, n, e, t in _chain([r[:2] for r in edge_rows]))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in got) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert FP.fingerprints(no_docs).count() == 0


def test_one_document(spark):
    r = FP.fingerprints(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")).collect()[0]
    assert r.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and r.near_next == 1.0


@pytest.mark.parametrize("per_range", [7, 4096])
def test_likeness_on_the_table(docs, per_range):
    got = FP.fingerprints(docs, rows_per_range=per_range).collect()
    own = {d: (n, hashlib.sha256(e.encode()).hexdigest()) for d, n, e, _ in _chain([(r.doc_id, r.text) for r in docs.collect()])}
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == own
    assert sum(r.near_edited > r.near_next for r in got) >= 0.97 * len(got)
    assert sum(r.near_next < 0.3 for r in got) >= 0.95 * len(got)


LONG = "Lorem ipsum dolor sit amet, " * 40_000


def _gram_cosine(a, b):
    """Cosine of the counts of eight-byte runs, without lanes."""
    a, b = (Counter(t[k:k + 8] for k in range(len(t) - 7)) for t in (a, b))
    return sum(n * b[g] for g, n in a.items()) / (sum(n * n for n in a.values()) * sum(n * n for n in b.values())) ** 0.5


@pytest.mark.parametrize("here, after", [
    (LONG, "sed do eiusmod tempor incididunt ut labore " * 26_000), (LONG, LONG[:500_000]), ("a" * 65_543, "a" * 65_600),
    ("xyz " * 200_000, "xyz " * 100_000 + words(50_000)), ("a" * 140_000, "b" * 140_000)])
def test_likeness_of_long_repetitive_texts(spark, here, after):
    r = FP.fingerprints(spark.createDataFrame([(2, here), (1, after)], "doc_id long, text string")).where("doc_id = 2").first()
    n = len(here) // 2
    assert r.near_edited == pytest.approx(_gram_cosine(here, here[:len(here) - n] + after[:n]), abs=0.15)
    assert r.near_next == pytest.approx(_gram_cosine(here, after), abs=0.15)
    one = FP.fingerprint(here.encode())
    assert FP.combine(FP.combine(one, one), one, remove=True) == one


ATOMS = ["a", "\\", "</turn>", "### ", ": ", "\n", "<", "#", " ", "assistant", "</turn>\n", "é", ":", "### user: "]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(ATOMS), max_size=3).map("".join), st.lists(st.sampled_from(ATOMS), max_size=8).map("".join)), max_size=4),
       st.integers(1, 9))
def test_round_trip(turns, step):
    text = "".join(C.render_turn(*t)[0] for t in turns)
    reader, got = C.TurnReader(), []
    for k in range(0, len(text), step):
        got += reader.feed(text[k:k + step])
    reader.close()
    assert got == turns


def test_escape_levels():
    assert C.render_turn("user", "plain: text")[3] == 0
    assert C.render_turn("user", C.HARD_TEXT)[3] == 1 and C.render_turn("a: b", "")[3] == 1
    for bad in ("x", "### user: text", "### user: ### </turn>\n", "### user: a\\"):
        with pytest.raises(C.GrammarError):
            reader = C.TurnReader()
            reader.feed(bad)
            reader.close()


def _conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "assistant", None), (2, 0, None, "x"), (2, None, "user", "first"), (3, 0, "user", "q"),
            (3, 0, "user", "q"), (None, 0, "user", "n"), (None, 1, "assistant", "m"), (4, 0, "assistant", "### user: </turn>\n\\"), (4, 1, "assistant", ""),
            (5, 0, "ro:le: x\n", "é😀" * 1000), (6, 0, "assistant", "long " * 300_000)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as formatted", "2 as position", "3 as level")


def test_format_and_read_back(spark):
    conv = _conversations(spark)
    got = C.read_back(C.format_turns(conv.repartition(5)))
    assert rows_of(got) == duck(C.ORACLE_SQL.replace("FROM conversations", "FROM conversations")
                                .replace("UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'", "")
                                .replace("UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'", ""),
                                conversations=conv.select("conv_id", "turn", "role", "text").toPandas().astype({"turn": "Int64", "conv_id": "Int64"}))
    formatted = C.format_turns(conv).where("conv_id = 4").orderBy("position").collect()
    whole = "".join(r.formatted for r in formatted)
    assert [whole[r.loss_start:r.loss_stop] for r in formatted] == ["\\### user: \\</turn>\n\\\\".replace(": ", "\\: "), ""]


def test_table_with_hard_conversation(spark):
    conv = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = rows_of(C.read_back(C.format_turns(C.with_hard_conversation(conv))))
    assert got == duck(C.ORACLE_SQL, conversations=conv.toPandas())
    none = C.read_back(C.format_turns(C.with_hard_conversation(conv.limit(0)))).collect()
    text = C.HARD_TEXT
    assert [(r.conv_id, r.n_turns, r.loss_chars, r.loss_sha256) for r in none] == [(-7, 2, len(text), hashlib.sha256(text.encode()).hexdigest())]
    assert C.read_back(C.format_turns(conv.limit(0))).count() == 0


def test_random_turns_keep_their_order(spark):
    r = random.Random(4)
    rows = [(c, t, r.choice(["user", "assistant"]), r.choice(ATOMS) * r.randrange(4)) for c in range(40) for t in range(r.randrange(1, 30))]
    r.shuffle(rows)
    got = C.read_back(C.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    for g in got:
        own = sorted(x for x in rows if x[0] == g.conv_id)
        assert g.turns_sha256 == hashlib.sha256("".join(f"{x[2]}\n{x[3]}\n" for x in own).encode()).hexdigest()
        assert g.n_turns == len(own) and g.loss_chars == sum(len(x[3]) for x in own if x[2] == "assistant")


@pytest.mark.parametrize("unit", ["ab\\", "\\</turn>", "</turn>", ": ### \\"])
def test_long_texts_of_escapes_are_linear(unit):
    import time
    text = unit * (5_000_000 // len(unit))
    began = time.monotonic()
    formatted, start, stop, _ = C.render_turn("user", text)
    reader = C.TurnReader()
    assert reader.feed(formatted) == [("user", text)]
    reader.close()
    assert time.monotonic() - began < 40
