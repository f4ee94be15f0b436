"""Model-based scoring run: isolation scores, out-of-fold boosted scores,
ensemble tiers, the refit model and attributions of the top-k providers."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.models import boost as B
from peerscope.models import explain as X
from peerscope.models import isolation as I
from peerscope.models import smote as SM
from peerscope.models.bundle import save_bundle
from peerscope.operators import scoring as S
from peerscope.operators.peers import FEATURE_COLUMNS, model_matrix
from peerscope.session import materialize


@dataclass
class ModelParams:
    iso_trees: int = I.N_TREES
    iso_samples: int = I.MAX_SAMPLES
    boost: B.BoostParams = field(default_factory=B.BoostParams)
    folds: int = 5
    top_k: int = S.REASONS_TOP_K
    background: int = X.N_BACKGROUND


class ModelRun:
    """Lazily computed, materialised model outputs over a feature table."""

    def __init__(self, features: DataFrame, params: ModelParams | None = None):
        self.features = features
        self.params = params or ModelParams()

    @cached_property
    def matrix(self) -> DataFrame:
        return materialize(model_matrix(self.features, fill_nulls=True), "matrix")

    @cached_property
    def forest(self) -> tuple[DataFrame, int]:
        """Node table of the isolation forest and its sample size."""
        p = self.params
        nodes, psi = I.grow_forest(self.matrix, FEATURE_COLUMNS, n_trees=p.iso_trees, max_samples=p.iso_samples)
        return materialize(nodes, "iso_nodes"), psi

    @cached_property
    def isolation_raw(self) -> DataFrame:
        return materialize(I.score_forest(self.matrix, *self.forest, FEATURE_COLUMNS), "iso_raw")

    @cached_property
    def isolation(self) -> DataFrame:
        return S.minmax_scale(self.isolation_raw, "iso_raw", "fraud_score_iso").select("npi", "fraud_score_iso")

    @cached_property
    def _fits(self) -> tuple:
        """Out-of-fold scores and the refit model: all models are trained together."""
        p = self.params
        syn = self.smote_rows if p.boost.oversample else None
        oof, model = B.fit_all(self.matrix, FEATURE_COLUMNS, k=p.folds, params=p.boost, synthetic=syn)
        return materialize(oof, "oof"), model

    @property
    def out_of_fold(self) -> DataFrame:
        return self._fits[0]

    @cached_property
    def scores(self) -> DataFrame:
        """M7 from the two models: npi, both scores, ensemble, tier."""
        j = self.out_of_fold.select("npi", "fraud_score_xgb").join(self.isolation, "npi", "inner")
        return materialize(S.ensemble(j), "model_scores")

    @cached_property
    def knn(self) -> DataFrame:
        """Exact k nearest minority neighbours over the whole table."""
        mino = self.matrix.where(F.col("is_fraud_label") == 1).select("npi", *FEATURE_COLUMNS)
        return materialize(SM.minority_knn(mino, FEATURE_COLUMNS), "knn_all")

    @cached_property
    def smote_rows(self) -> DataFrame:
        """SMOTE rows for the whole table (used by the refit model)."""
        rows = self.matrix.select("npi", *FEATURE_COLUMNS, "is_fraud_label")
        return materialize(SM.smote(rows, FEATURE_COLUMNS, seed=self.params.boost.seed, knn=self.knn,
                                    few=self.params.boost.few_minority), "smote_all")

    @property
    def final_model(self):
        return self._fits[1]

    def save_bundle(self, path: str) -> None:
        """The refit model, the forest and the F2 threshold of the out-of-fold scores, in one folder."""
        from peerscope.operators.metrics import f2_threshold
        labelled = self.out_of_fold.join(self.matrix.select("npi", "is_fraud_label"), "npi")
        cut = f2_threshold(labelled.selectExpr("fraud_score_xgb AS score", "is_fraud_label AS label")).first()["best_threshold"]
        span = self.isolation_raw.agg(F.min("iso_raw"), F.max("iso_raw")).first()
        save_bundle(path, self.matrix.sparkSession, self.final_model, *self.forest, (span[0], span[1]), cut)

    @cached_property
    def attributions(self) -> DataFrame:
        """M8 for the top-k providers by ensemble score."""
        top = S.top_k_by_score(self.scores.select("npi", "fraud_score_ensemble"), self.params.top_k)
        fg = self.matrix.join(top.select("npi"), "npi", "left_semi")
        bg = X.background_sample(fg, self.params.background)
        return materialize(X.attributions(self.final_model, fg, bg, FEATURE_COLUMNS), "attributions")

    @cached_property
    def reasons(self) -> DataFrame:
        """M9: top-3 reason strings from the attributions."""
        return S.top_reasons(self.attributions, FEATURE_COLUMNS)

    def attribution_long(self) -> DataFrame:
        """Attributions in long form: npi, feature, value, impact."""
        items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"v_{c}").alias("value"),
                                   F.col(f"i_{c}").alias("impact")) for c in FEATURE_COLUMNS])
        return self.attributions.select("npi", "base_value", "log_odds", F.inline(items))
