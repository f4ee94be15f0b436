"""Operators 2, 7 and 9: held-out accuracy, planted cases, edge cases."""

import zlib

import numpy as np
import pytest

from llm_helpers import rows_of
from peerscope.llm import licenses as L
from peerscope.llm import quality as Q
from peerscope.llm import toxicity as T
from peerscope.llm.features import KEEP_ALL, LETTERS, Hashed


def test_grams_and_words_of_the_buffer():
    h = Hashed([b"ab cab", b"", b"cab x"], KEEP_ALL, 20)
    at, bucket = h.grams(3)
    grams = {bytes(h.buf[k:k + 3]) for k in at.tolist()}
    assert grams == {b" ab", b"ab ", b" ca", b"cab", b" x "} - {b" x "} or grams == {b" ab", b"ab ", b" ca", b"cab"}
    by = {}
    for k, b in zip(at.tolist(), bucket.tolist()):
        assert by.setdefault(bytes(h.buf[k:k + 3]), b) == b
    at, bucket = h.words()
    assert h.owners(at).tolist() == [0, 0, 2, 2] and bucket[1] == bucket[2] and len(set(bucket.tolist())) == 3
    assert Hashed([b"x x y", b"y"], KEEP_ALL, 10).repeats().size == 1


@pytest.fixture(scope="module")
def quality_model(labelled_docs, labels):
    return Q.fit(labelled_docs, labels)


def test_quality_on_held_out_rows(labelled_docs, labels, quality_model):
    got = Q.score(labelled_docs, quality_model).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 50 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.95
    assert all(r.predicted == (r.score >= 0.7) for r in got)


def test_quality_ignores_labels_of_held_out_rows(spark, labelled_docs, labels):
    from pyspark.sql import functions as F
    spoiled = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = Q.fit(labelled_docs, labels, max_train=120), Q.fit(labelled_docs, spoiled, max_train=120)
    assert np.array_equal(a.table, b.table) and a.bias == b.bias


def test_quality_training_equals_scoring_features():
    rows = Q.feature_sets([b"some words words here", b"other text", b""])
    m = Q.train(rows, np.array([1, 0, 1]), epochs=3)
    z = [m.bias + float((m.table[at] * w).sum()) for at, w in rows]
    assert np.allclose(m.score([b"some words words here", b"other text", b""]), 1 / (1 + np.exp(-np.array(z))), atol=1e-5)


def test_quality_sample_is_bounded_in_bytes(spark):
    rows = [(k, bytearray(8 * k), bytearray(2 * k)) for k in range(1, 21)]
    for schema, cast in (("doc_id long, at binary, weight binary", int), ("doc_id string, at binary, weight binary", str)):
        sample = spark.createDataFrame([(cast(k), a, w) for k, a, w in rows], schema)
        assert Q.within_bytes(sample, 10 * 210).count() == 20 and Q.within_bytes(sample, 0).count() == 0
        for bound in (5, 300, 1000, 2099):
            got = Q.within_bytes(sample, bound)
            used = sum(len(r.at) + len(r.weight) for r in got.collect())
            order = [r.doc_id for r in sample.selectExpr("doc_id", "xxhash64(doc_id) h").orderBy("h", "doc_id").collect()]
            kept = {r.doc_id for r in got.collect()}
            assert used <= bound and kept == set(order[:len(kept)])
            if len(kept) < 20:
                assert used + 10 * int(order[len(kept)]) > bound


def test_quality_very_long_texts_within_the_bound(spark):
    import random
    r = random.Random(3)
    texts = [(k, " ".join("".join(r.choices("abcdefghij", k=6)) for _ in range(3000)), k % 2) for k in range(24)]
    table = spark.createDataFrame(texts, "doc_id long, text string, quality int")
    seen = []
    train = Q.train
    Q.train = lambda sets, y, bits: seen.append(sum(a.nbytes + w.nbytes for a, w in sets)) or train(sets, y, bits, epochs=1)
    try:
        for bound in (1 << 30, 400_000, 0):
            m = Q.fit(table.select("doc_id", "text"), table.select("doc_id", "quality"), max_bytes=bound)
            assert 0 < m.score([b"any"])[0] < 1
    finally:
        Q.train = train
    assert seen[0] > 400_000 >= seen[1] > seen[2] == 0


def _edge_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 0), (None, 1, 1), (3, None, None), (999, 0, 1)], "doc_id long, quality int, toxic int")


def test_quality_edges(spark, edge_docs, no_docs, quality_model):
    got = Q.score(edge_docs, quality_model).collect()
    assert len(got) == edge_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert Q.score(no_docs, quality_model).count() == 0
    assert Q.reject(edge_docs, quality_model).columns == edge_docs.columns
    for labels in (_edge_labels(spark), _edge_labels(spark).limit(0)):
        for table in (edge_docs, no_docs):
            m = Q.fit(table, labels)
            assert 0 < m.score([b""])[0] < 1
    assert rows_of(Q.reject(edge_docs, Q.Model(np.zeros(1 << 10, np.float32), 3.0))) == rows_of(edge_docs)


@pytest.fixture(scope="module")
def chain(labelled_docs, labels):
    return T.fit(labelled_docs, labels)


def test_toxicity_on_other_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    chain = T.fit(docs, labels.where("doc_id % 3 <> 0"))
    other = labels.where("doc_id % 3 = 0")
    got = T.score(docs.join(other, "doc_id").select("doc_id", "text"), chain).join(other, "doc_id").collect()
    toxic, clean = [r.is_toxic for r in got if r.toxic], [r.is_toxic for r in got if not r.toxic]
    # a tenth of the toxic labels of this table are on texts without any toxic word
    assert len(toxic) > 100 and np.mean(toxic) >= 0.85 and np.mean(clean) <= 0.01


def test_chain_feeds_earlier_probabilities(chain):
    assert [m.chain.size for m in chain.models] == [0, 1, 2]
    assert chain.models[1].chain[0] > 0 or chain.models[2].chain.max() > 0
    p = chain.probabilities([b"you idiot and moron", b"", "ruhig und schön".encode()])
    assert p.shape == (3, 3) and p[0, -1] > 0.5 > p[1, -1] and p[2, -1] < T.THRESHOLD
    assert not chain.probabilities([b"idiots" * 0 + b"the idio tic"])[0, -1] > 0.99


def test_toxicity_edges(spark, edge_docs, no_docs, chain):
    got = T.score(edge_docs, chain)
    assert got.count() == edge_docs.count() and got.columns == ["doc_id", "p_kind_1", "p_kind_2", "p_toxic", "is_toxic"]
    assert T.score(no_docs, chain).count() == 0
    assert rows_of(T.reject(edge_docs, chain)) == rows_of(edge_docs)
    for table in (edge_docs, no_docs):
        for labels in (_edge_labels(spark), _edge_labels(spark).limit(0)):
            p = T.fit(table, labels).probabilities([b"any text", b""])
            assert ((p > 0) & (p < 1)).all()


def test_toxicity_driver_gets_kept_features_only(labelled_docs, labels, monkeypatch):
    seen = {}
    train = T.train
    monkeypatch.setattr(T, "train", lambda features, targets, folds, active, **kw: seen.update(
        features=[f.copy() for f in features], active=active) or train(features, targets, folds, active, **kw))
    T.fit(labelled_docs, labels)
    kept = np.unique(np.concatenate(list(seen["active"].values())))
    assert len(seen["active"]) == 11 and max(a.size for a in seen["active"].values()) <= T.N_FEATURES
    assert len(seen["features"]) == labels.count() and all(np.isin(f, kept).all() for f in seen["features"])


def test_toxicity_rejects_from_the_held_out_threshold_on(spark):
    docs = spark.createDataFrame([(1, "any text")], "doc_id long, text string")
    for p, n in ((0.19, 1), (0.21, 0), (0.39, 0)):
        c = T.Chain(10, ("toxic",), [T.Linear(np.zeros(0, np.int64), np.zeros(0), np.zeros(0), float(np.log(p / (1 - p))))])
        assert T.reject(docs, c).count() == n and T.score(docs, c).first().is_toxic == (n == 0)


def test_toxicity_keeps_frequent_features_that_separate(spark):
    import random
    r = random.Random(5)
    words = ["".join(r.choices("abcdefghiklmnoprstu", k=7)) for _ in range(300)]

    def text(toxic):
        own = r.choices(words, k=30) + (["zorblax", "quimfest"] if toxic else [])
        return " ".join(["preface", *r.sample(own, len(own))])

    rows = [(k, text(k % 5 < 2), int(k % 5 < 2)) for k in range(200)]       # 40 % toxic, all with the same words
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = T.fit(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    p = [model.probabilities([text(y).encode() for _ in range(50)])[:, -1] for y in (True, False)]
    assert p[0].min() >= T.THRESHOLD > p[1].max()


def _two_families(n=300):
    """Clean rows, and toxic ones with words of one of two invented families, in a script of their own."""
    import random
    r = random.Random(11)
    words = ["".join(r.choices("abcdefghiklmnoprstu", k=7)) for _ in range(400)]
    families = (["жуфак", "жорлон", "жимпур", "жабрет"], ["кветун", "кразол", "кипсарт", "колдуэн"])
    rows = []
    for k in range(n):
        kind = k // 2 % 2 if k % 2 else None
        own = r.sample(words, 30) + (r.sample(families[kind], 2) if k % 2 else [])
        rows.append((k, " ".join(r.sample(own, len(own))), k % 2, kind))
    return rows, families


def test_toxicity_kinds_come_from_the_labelled_rows(spark):
    rows, families = _two_families()
    table = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, toxic int")
    model = T.fit(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    p = model.probabilities([r[1].encode() for r in rows])
    kinds = np.array([-1 if r[3] is None else r[3] for r in rows])
    first = 0 if p[kinds == 0, 0].mean() > 0.5 else 1       # which group is which family is not fixed
    for kind, column in ((0, first), (1, 1 - first)):
        assert p[kinds == kind, column].min() > 0.5 > p[kinds == 1 - kind, column].max()
        assert p[kinds == -1, column].max() < 0.5
    assert p[kinds >= 0, -1].min() >= T.THRESHOLD > p[kinds == -1, -1].max()
    assert all(m.features.size for m in model.models[:2])       # each kind has a model of its own
    assert model.models[2].chain.max() > 0
    unseen = [" ".join(["ordinary words here", *f[:2]]).encode() for f in families]
    assert (model.probabilities(unseen)[:, -1] >= T.THRESHOLD).all()


def test_toxicity_runs_one_python_step_a_stage(spark, monkeypatch):
    """A second worker beside the first, in every core, is memory that the executor keeps."""
    docs = spark.createDataFrame([(k, f"{'gromble' if k % 2 else 'meadow'} words of text number {k} and more") for k in range(40)], "doc_id long, text string")
    own, plans = T.map_text, []

    def spy(df, *args, **kw):
        out = own(df, *args, **kw)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    monkeypatch.setattr(T, "map_text", spy)
    chain = T.fit(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic"))
    T.score(docs, chain)
    assert len(plans) >= 6 and all(p.count("MapInArrow") == 1 for p in plans)


def test_toxicity_memory_of_a_scoring_step():
    """Follows the bytes of a chunk, not those of the batch that Spark sends."""
    import tracemalloc

    import pyarrow as pa
    from peerscope.llm.common import byte_texts, text_chunks
    texts = [f"number {'abcdefghij'[k % 10] * (k % 7 + 1)} some words " * 40 for k in range(8000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    one = T.Linear(np.arange(0, 1 << T.BITS, 16), np.linspace(-1, 1, 1 << T.BITS - 4), np.zeros(0), 0.0)
    chain = T.Chain(T.BITS, ("toxic",), [one])
    whole = chain.probabilities([t.encode() for t in texts[:2000]])
    tracemalloc.start()
    got = np.concatenate([chain.probabilities(byte_texts(c)) for c in text_chunks([batch], "text", T.CHUNK_BYTES)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(got[:2000], whole) and np.ptp(got) > 0.01 and peak < 25e6


def test_toxicity_groups_by_hand():
    telling = np.array([3, 5, 8, 9, 12])
    features = [np.array(f, dtype=np.int32) for f in ([3, 5], [3, 5], [3, 5], [8, 9], [8, 9], [12], [12, 3], [])]
    toxic = np.array([1, 1, 1, 1, 1, 0, 0, 0])
    a, b = T._groups(features, toxic, telling)
    assert a.tolist() == [3, 5] and b.tolist() == [8, 9]        # 12 tells clean documents
    none = T._groups(features, np.zeros(8, dtype=int), telling)
    assert [g.size for g in none] == [0, 0]
    assert [g.tolist() for g in T._groups([np.array([3], dtype=np.int32), np.zeros(0, np.int32)], np.array([1, 0]), np.array([3]))] == [[3], []]
    assert [g.size for g in T._groups([], np.zeros(0, dtype=int), np.zeros(0, dtype=int))] == [0, 0]


def test_toxicity_features_equal_chi_square_over_the_sample(labelled_docs, labels, monkeypatch):
    seen = {}
    monkeypatch.setattr(T, "train", lambda features, targets, folds, active, **kw: seen.update(targets=targets, folds=folds, active=active))
    T.fit(labelled_docs, labels, bits=16)
    texts = labelled_docs.join(labels.select("doc_id").distinct(), "doc_id").orderBy("doc_id").collect()
    found = [np.unique(T._features(Hashed([r.text.encode()], LETTERS, 16))[1]) for r in texts]
    assert len(found) == len(seen["targets"])
    for (k, out), active in seen["active"].items():
        own = np.flatnonzero(seen["folds"] != (-1 if out is None else out))
        y = seen["targets"][own, k]
        df = np.bincount(np.concatenate([found[d] for d in own]), minlength=1 << 16).astype(float)
        pos = np.bincount(np.concatenate([found[d] for d in own[y > 0]]), minlength=1 << 16)
        expect = df * y.mean()
        chi = np.where(df >= 3, (pos - expect) ** 2 / np.maximum(expect * (1 - y.mean()) * (1 - df / own.size), 1e-9), 0)
        want = np.argsort(-chi, kind="stable")[:T.N_FEATURES]
        assert active.tolist() == sorted(want[chi[want] > 4].tolist())


@pytest.fixture(scope="module")
def license_model(docs):
    return L.fit(docs)


def test_license_lines_of_the_table(labelled_docs, license_model):
    import re
    names = {"MIT License": "mit", "Apache License": "apache", "GNU General Public License": "gpl", "CC BY-NC": "cc-by-nc"}
    got = {r.doc_id: r for r in L.scan(labelled_docs, license_model).collect()}
    found = 0
    for r in labelled_docs.collect():
        want = sorted({f for n, f in names.items() if n in r.text})
        assert got[r.doc_id].families == want and got[r.doc_id].n_paragraphs == r.text.count("\n") + 1
        assert got[r.doc_id].n_notices == len(re.findall(r"(?m)^.*(?:MIT License|Apache License|GNU General Public License|CC BY-NC).*$", r.text))
        found += bool(want)
    assert found > 10


def test_templates_and_lookalikes(license_model):
    for family, texts in L.TEMPLATES.items():
        for t in texts:
            line, bucket, per = L._grams([t.encode()])
            assert L.FAMILIES[license_model.probabilities(line, bucket, 1)[0].argmax()] == family, t
            assert L.confirm(t.encode(), family) == 1
    for t in ("All rights reserved.", "we released the bridge", "Licensed under the Foo License, Version 2.0."):
        line, bucket, _ = L._grams([t.encode()])
        p = license_model.probabilities(line, bucket, 1)[0]
        best = L.FAMILIES[p.argmax()]
        assert best == L.UNKNOWN or L.confirm(t.encode(), best) < L.MIN_CONTAINED


def test_license_probabilities_are_calibrated(license_model):
    rows = L.variations(["plain words of a text", "another ordinary line"], seed=77)
    y = np.array([k for _, k in rows])
    line, bucket, _ = L._grams([t.encode() for t, _ in rows])
    p = license_model.probabilities(line, bucket, len(rows))
    assert (p.argmax(1) == y).mean() > 0.97 and abs(p.max(1).mean() - (p.argmax(1) == y).mean()) < 0.05


def test_license_edges(spark, edge_docs, no_docs, license_model):
    got = {str(r.doc_id): r for r in L.scan(edge_docs, license_model).collect()}
    assert got["4"].n_paragraphs == 0 and got["5"].n_paragraphs == 0 and got["6"].n_paragraphs == 2 and got["6"].families == []
    assert L.scan(no_docs, license_model).count() == 0 and L.fit(no_docs).bias.size == len(L.FAMILIES)
    text = "\n\nReleased under the MIT License.\n\nplain\nLicensed under the MIT License.\nLicensed under CC BY-NC 4.0.\n"
    r = L.scan(spark.createDataFrame([(1, text), (2, None), (3, "\n")], "doc_id long, text string"), license_model).orderBy("doc_id").collect()
    assert (r[0].families, r[0].n_notices, r[0].n_paragraphs) == (["cc-by-nc", "mit"], 3, 8) and [n.paragraph for n in r[0].notices] == [2, 5, 6]
    assert (r[1].n_paragraphs, r[2].n_paragraphs, r[2].families) == (0, 2, [])


MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files "
       "(the \"Software\"), to deal")
BSD = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:")
GPL = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
       "# the Free Software Foundation.")


@pytest.mark.parametrize("text, want", [
    (MIT, [(0, "mit")]), (f"plain words\n\n{BSD}\n\nmore", [(2, "bsd")]), (f"{GPL}\n#\n# tail", [(0, "gpl")]),
    (f"{MIT}\n\n{BSD}\n\n{MIT}", [(0, "mit"), (3, "bsd"), (7, "mit")]),
    ("\n".join(L.TEMPLATES["mit"][2].split()), [(0, "mit")]),
    ("Licensed under CC BY 3.0.", [(0, "cc-by")]), ("Licensed under the Apache License, Version 1.1.", [(0, "apache")]),
    ("Licensed under the\nApache License, Version 1.1.", [(0, "apache")]), ("Released under the BSD 2-Clause License.", [(0, "bsd")]),
    ("Permission is hereby granted, free of charge,\n\nto any person obtaining a copy of this software", [])])
def test_wrapped_notices_and_other_versions(spark, license_model, text, want):
    r = L.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), license_model).first()
    assert [(n.paragraph, n.family) for n in r.notices] == want and r.n_notices == len(want)
    assert r.families == sorted({f for _, f in want}) and r.n_paragraphs == text.count("\n") + 1


@pytest.mark.parametrize("text, want", [
    ("Licensed under CC BY-NC-SA 4.0.", ["cc-by-nc-sa"]), ("Licensed under CC BY-ND 4.0.", ["cc-by-nd"]), ("CC BY-ND 4.0", []),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", ["cc-by-nc-nd"]),
    (L.TEMPLATES["agpl"][0], ["agpl"]), ("This text is not released under the MIT License.", []), ("It was never released under the MIT License.", []),
    ("This is not a copy. Released under the MIT License.", ["mit"]), ("SPDX-License-Identifier: MIT", ["mit"]),
    ("SPDX-License-Identifier: Apache-2.0", ["apache"]), ("# SPDX-License-Identifier: GPL-2.0-or-later", ["gpl"]),
    ("// SPDX-License-Identifier: LGPL-2.1-only", ["lgpl"]), ("SPDX-License-Identifier: Zlib", []), (L.TEMPLATES["isc"][0], ["isc"]),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", ["gpl"]), ("Apache License\nVersion 2.0, January 2004", ["apache"]),
    (L.TEMPLATES["apache"][1], ["apache"]), ("See the notes. Licensed under the Apache License, Version 2.0. You may not copy the logo.", ["apache"])])
def test_families_that_words_beside_a_notice_change(spark, license_model, text, want):
    assert L.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), license_model).first().families == want


def test_ordinary_lines_come_from_whole_texts(spark):
    rows = [(k, "same head\n" + "\n".join(f"line {k} {j}" for j in range(40))) for k in range(60)] + [(99, None), (100, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = L.ordinary_lines(docs, k=50)
    assert len(got) == len(set(got)) == 50 and len({t.split()[-1] for t in got}) > 15
    assert L.ordinary_lines(spark.createDataFrame([(k, "same") for k in range(90)], "doc_id long, text string"), k=5) == ["same"]


def _scan_by_hand(lines, model):
    out = []
    for k, t in enumerate(lines):
        line, bucket, _ = L._grams([t])
        p = model.probabilities(line, bucket, 1)[0]
        best = int(p[1:].argmax()) + 1
        if t.strip() and p[best] >= L.MIN_PROBABILITY and L.confirm(t, L.FAMILIES[best]) >= L.MIN_CONTAINED:
            out.append((k, L.FAMILIES[best]))
    return out


def test_scan_equals_single_lines_by_hand(spark, license_model):
    """Random texts of notices, their parts and plain lines: batched scanning finds what line after line finds."""
    rng = np.random.default_rng(4)
    pool = [t for own in L.TEMPLATES.values() for t in own] + list(L.LOOKALIKES) + ["plain words", "another line of text", ""]
    texts = ["\n".join((str(rng.choice(pool)) if rng.random() < 0.7 else " ".join(str(rng.choice(pool)).split()[:5])) + "\n"
                       for _ in range(int(rng.integers(1, 9)))) for _ in range(60)]     # a blank line after each: no runs
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in L.scan(docs, license_model).collect():
        assert [(n.paragraph, n.family) for n in r.notices] == _scan_by_hand(texts[r.doc_id].encode().split(b"\n"), license_model)


def test_recall_and_false_positives_on_planted_notices(spark, license_model):
    rows, want = [], []
    for f, own in L.TEMPLATES.items():
        for t in own:
            for around in ("{}", "Notice: {}", "the notes say {} and end", "* {}"):
                rows.append(around.format(t))
                want.append(f)
    denied = [f"This is not {t[0].lower()}{t[1:]}" for own in L.TEMPLATES.values() for t in own if t.startswith(("Licensed", "Released", "Distributed"))]
    docs = spark.createDataFrame(list(enumerate(rows + denied)), "doc_id long, text string")
    got = {r.doc_id: r.families for r in L.scan(docs, license_model).collect()}
    caught = sum(got[k] == [f] for k, f in enumerate(want))
    wrong = sum(bool(set(got[k]) - {f}) for k, f in enumerate(want)) + sum(bool(got[len(rows) + k]) for k in range(len(denied)))
    print("caught", caught, "of", len(rows), "wrong", wrong, "of", len(rows) + len(denied))
    assert caught >= 0.97 * len(rows) and wrong == 0
