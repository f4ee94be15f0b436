"""Output sinks of a run (S5, S6, S14): the cleaned providers (partitioned by
data year), benchmarks, provider features, scores, alerts and a one-row
metrics JSON, each written once with overwrite semantics."""

from __future__ import annotations

from pyspark.sql import DataFrame

from peerscope.operators import metrics as M
from peerscope.plans.views import Workspace
from peerscope.sources.files import write_json_metrics, write_table


def curve_summary(scored: DataFrame, score: str = "fraud_score_xgb", label: str = "is_fraud_label") -> DataFrame:
    """One row: pr_auc, roc_auc and the F2-optimal threshold (S14 layout)."""
    ev = scored.select(scored[score].alias("score"), scored[label].alias("label"))
    cm = M.curve_metrics(ev).select("pr_auc", "roc_auc")
    return cm.crossJoin(M.f2_threshold(ev).selectExpr("best_threshold AS threshold"))


def export_outputs(ws: Workspace, out_dir: str) -> dict[str, str]:
    """Writes the outputs of a run with model scores; the stand-in scores of a workspace without a
    model are for checks only and are refused."""
    if ws.model is None:
        raise ValueError("no model scores to export: use ws.with_model(ModelRun(ws.features))")
    out = out_dir.rstrip("/")
    paths = {
        "providers": f"{out}/providers",
        "specialty_benchmarks": f"{out}/specialty_benchmarks",
        "provider_features": f"{out}/provider_features",
        "scores": f"{out}/scores",
        "fraud_alerts": f"{out}/fraud_alerts",
        "metrics": f"{out}/metrics",
    }
    write_table(ws.providers, paths["providers"], partition_by=["data_year"])
    write_table(ws.benchmarks, paths["specialty_benchmarks"])
    write_table(ws.provider_features, paths["provider_features"])
    write_table(ws.scores, paths["scores"])
    write_table(ws.alerts, paths["fraud_alerts"])
    write_json_metrics(curve_summary(ws.providers_scored), paths["metrics"])
    return paths
