"""The pipeline's stages against what is planted in their input."""

import corpus_pipeline as P
from llm_helpers import rows_of, words
from peerscope.llm import decontaminate, ngram_join
from peerscope.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


def test_registry():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 11)) and set(ORACLES) <= set(QUERIES)
    import __spark_entry__
    assert "pipeline" in __spark_entry__.queries() and set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_stages(spark, labelled_docs, labels):
    clean = "\n".join(f"the thing of {words(12, 40 * k)} and that was it" for k in range(12))
    passage = " ".join(spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text.split()[:30])
    planted = [(10**6, clean), (10**6 + 1, clean), (10**6 + 2, clean.replace("w42 ", "changed ")), (10**6 + 3, "Idiot. " + clean.replace("w1", "v1") + " you moron, idiot"),
               (10**6 + 4, clean.replace("w", "q") + "\n" + passage + " end")]
    docs = labelled_docs.unionByName(spark.createDataFrame(planted, "doc_id long, text string").selectExpr("*", "'en' as lang", "'s' as source", "length(text) as n_chars").select(*labelled_docs.columns))
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    good = {r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()}
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}

    one = P.materialize(P.drop_toxic(spark, docs, SF), "t")
    assert one.columns == docs.columns
    left = ids(one)
    assert 10**6 + 3 not in left and {10**6, 10**6 + 1, 10**6 + 2, 10**6 + 4} <= left
    assert len(toxic & left) <= 0.1 * len(toxic) and len(good & left) >= 0.99 * len(good)

    two = P.materialize(P.drop_low_quality(spark, one, SF), "t")
    assert two.columns == docs.columns and len(bad & ids(two)) <= 0.1 * len(bad & left) and len(good & ids(two)) >= 0.98 * len(good & left)

    mine = two.where("doc_id >= 1000000 or doc_id < 300").unionByName(spark.createDataFrame([docs.where("doc_id = 1000001").first()], docs.schema)).unionByName(
        docs.where("doc_id in (1000000, 1000002, 1000004)")).dropDuplicates(["doc_id"])
    three = P.materialize(P.drop_near_duplicates(spark, mine, SF), "t")
    want = ngram_join.brute_force({r.doc_id: r.text for r in mine.collect()}, n=5, threshold=0.8)
    assert three.columns == docs.columns and ids(three) == {k for k, v in want.items() if v[1] == k}
    assert 10**6 in ids(three) and not {10**6 + 1, 10**6 + 2} & ids(three)

    four = P.materialize(P.cut_benchmark(spark, three, SF), "t")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert four.columns == docs.columns
    cut = {r.doc_id: r for r in four.collect()}
    assert passage not in cut[10**6 + 4].text and cut[10**6 + 4].n_chars == len(cut[10**6 + 4].text)
    hit = {r.doc_id for r in decontaminate.report(decontaminate.scan(three, bench)).where("contaminated").collect()}
    same = {r.doc_id: r for r in three.collect()}
    assert all(cut[k] == same[k] for k in same if k not in hit)

    last = P.pack(spark, four, SF)
    assert last.select("doc_id").distinct().count() == four.count()


def test_edges(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for _, stage in P.STAGES[:-1]:
            after = P.materialize(stage(spark, docs, "/root/testdata/sf0.001"), "t")
            assert after.columns == docs.columns
            docs = after
        assert P.pack(spark, docs, "").select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_run(spark):
    got = P.run(spark, "/root/testdata/sf0.001")
    assert rows_of(got) and got.columns[:2] == ["doc_id", "piece"]
