import json
import os
import tempfile

import pytest

from peerscope.models.boost import BoostParams
from peerscope.operators.peers import FEATURE_COLUMNS
from peerscope.plans.export import export_outputs
from peerscope.plans.models import ModelParams, ModelRun
from peerscope.plans.views import workspace


def test_export_refuses_stand_in_scores(spark):
    with pytest.raises(ValueError, match="model"):
        export_outputs(workspace(spark, "/root/testdata/sf0.001"), tempfile.mkdtemp(prefix="peerscope-export-"))


def test_model_run_reaches_alerts_and_export(spark):
    """The whole run with the real models (few rounds): scores, reasons, alerts and files agree."""
    ws = workspace(spark, "/root/testdata/sf0.01")
    run = ModelRun(ws.features, ModelParams(iso_trees=20, boost=BoostParams(n_trees=2), top_k=40))
    ws = ws.with_model(run)
    scored = {r.npi: r for r in ws.providers_scored.collect()}
    model = {r.npi: r for r in run.scores.collect()}
    assert len(scored) == len(model) and all(scored[k].fraud_score_xgb == model[k].fraud_score_xgb for k in model)
    alerts = ws.alerts.collect()
    assert len(alerts) == 40 and all(a.fraud_score == model[a.npi].fraud_score_ensemble for a in alerts)
    assert {a.reason_1.split(":")[0] for a in alerts} <= set(FEATURE_COLUMNS)
    impact = {(r.npi, r.feature): r.impact for r in run.attribution_long().collect()}
    for a in alerts:
        own = sorted((-abs(impact[a.npi, f]), k, f) for k, f in enumerate(FEATURE_COLUMNS))
        assert a.reason_1.startswith(own[0][2] + ":")

    paths = export_outputs(ws, tempfile.mkdtemp(prefix="peerscope-export-"))
    assert spark.read.parquet(paths["providers"]).count() == ws.providers.count()
    assert os.path.isdir(f"{paths['providers']}/data_year=2022")
    out = {r.npi: r.fraud_score_xgb for r in spark.read.parquet(paths["scores"]).collect()}
    assert out == {k: r.fraud_score_xgb for k, r in model.items()}
    assert spark.read.parquet(paths["fraud_alerts"]).count() == 40
    part = [f for f in os.listdir(paths["metrics"]) if f.endswith(".json")][0]
    m = json.loads(open(f"{paths['metrics']}/{part}").read())
    assert set(m) == {"pr_auc", "roc_auc", "threshold"} and 0.0 <= m["roc_auc"] <= 1.0
