import tempfile

import pytest
from pyspark.sql import functions as F

from peerscope.models import boost as B
from peerscope.models import isolation as I
from peerscope.models.bundle import Bundle, save_bundle


def test_bundle_scores_new_rows_alone(spark):
    rows = [(f"n{i:03d}", float(i % 13), float(i * i % 29), int(i % 9 == 0)) for i in range(120)]
    df = spark.createDataFrame(rows, "npi string, a double, b double, is_fraud_label int")
    feats = ["a", "b"]
    model = B.fit(df, feats, params=B.BoostParams(n_trees=3, oversample=False))
    nodes, psi = I.grow_forest(df, feats, n_trees=8, max_samples=32)
    raw = I.score_forest(df, nodes, psi, feats)
    lo, hi = raw.agg(F.min("iso_raw"), F.max("iso_raw")).first()
    path = tempfile.mkdtemp(prefix="peerscope-bundle-") + "/b"
    save_bundle(path, spark, model, nodes, psi, (lo, hi), threshold=0.5)
    bundle = Bundle(path, spark)
    assert list(bundle.features) == feats and bundle.settings["threshold"] == 0.5
    want = {r["npi"]: (r["iso_raw"] - lo) / (hi - lo) for r in raw.collect()}
    sup = {r["npi"]: r["fraud_score_xgb"] for r in B.predict(model, df).collect()}
    got = bundle.score(df).collect()
    assert len(got) == 120
    for r in got:
        assert r["fraud_score_iso"] == pytest.approx(want[r["npi"]], abs=1e-12) and r["fraud_score_xgb"] == sup[r["npi"]]
        assert r["flagged"] == (sup[r["npi"]] >= 0.5)
    # rows beyond the training range, NULL features, no rows, absent features
    far = spark.createDataFrame([("x", 1e9, -1e9), ("y", None, None)], "npi string, a double, b double")
    assert all(0.0 <= r["fraud_score_iso"] <= 1.0 for r in bundle.score(far).collect())
    assert bundle.score(far.limit(0)).count() == 0
    assert bundle.score(far.withColumnRenamed("a", "other"), rename={"other": "a"}).count() == 2
    with pytest.raises(ValueError, match="lack"):
        bundle.score(far.drop("b"))
    B.save_model(model, f"{path}-old/boosted", spark)
    with pytest.raises(ValueError, match="bundle"):
        Bundle(f"{path}-old", spark)
