"""The provider views every query reads, built once per session and source folder.

    providers_raw --clean--> providers --peers--> benchmarks, features
                                  \\--scores--> scores --> providers_scored
    provider_years_raw --standardise--> provider_years
    exclusions (npi, date), alerts (top-k reasons)

Each view is materialised to the session's reliable checkpoint folder, so
queries share one computation and a lost executor re-reads files instead of
recomputing the roll-up.
"""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from peerscope.functions import growing
from peerscope.operators import clean as C
from peerscope.operators import peers as P
from peerscope.operators import scoring as S
from peerscope.session import materialize
from peerscope.sources import fixture

# Columns of provider_features carried onto the scored provider view.
SCORED_FEATURE_COLUMNS = ["flag_count", "flag_high_volume", "flag_high_cost_per_claim", "flag_brand_heavy",
                          "flag_concentrated_benes", "flag_opioid_heavy", "z_total_claim_count",
                          "z_cost_per_claim", "z_brand_share", "z_opioid_share"]
SCORE_COLUMNS = ["fraud_score_xgb", "fraud_score_iso", "fraud_score_ensemble", "fraud_tier"]


class Workspace:
    """Lazily built, materialised provider views for one (session, folder)."""

    def __init__(self, spark: SparkSession, sf_dir: str, model=None):
        """``model``: a ``plans.models.ModelRun`` whose scores and reasons the views carry.  Without one they
        carry deterministic stand-ins that SQL can check; those are never exported."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.model = model

    def with_model(self, model) -> Workspace:
        """The same provider views with the scores and reasons of a model run."""
        out = Workspace(self.spark, self.sf_dir, model)
        for view in ("order_facts", "providers_raw", "providers", "_bench_and_features", "provider_years", "exclusions"):
            out.__dict__[view] = getattr(self, view)
        return out

    @cached_property
    def order_facts(self) -> DataFrame:
        """Per (customer, year) sums of the episode facts: the single pass over the claim lines."""
        return materialize(fixture.customer_year_facts(self.spark, self.sf_dir), "order_facts")

    @cached_property
    def providers_raw(self) -> DataFrame:
        # cleaning reads it twice (outlier quantiles and rows), so the roll-up is stored once
        return materialize(fixture.providers_raw(self.spark, self.sf_dir, self.order_facts), "providers_raw")

    @cached_property
    def providers(self) -> DataFrame:
        """Cleaned provider table (S7 names, data_year stamped)."""
        return materialize(C.to_provider_table(C.clean_providers(self.providers_raw)), "providers")

    @cached_property
    def _bench_and_features(self) -> tuple[DataFrame, DataFrame]:
        bench, feats = P.build_features(self.providers)
        return bench, materialize(feats, "features")

    @property
    def benchmarks(self) -> DataFrame:
        return self._bench_and_features[0]

    @property
    def features(self) -> DataFrame:
        """Providers with z_*, pct_*, flag_* columns."""
        return self._bench_and_features[1]

    @property
    def provider_features(self) -> DataFrame:
        return P.provider_features_table(self.features)

    @cached_property
    def scores(self) -> DataFrame:
        base = self.model.scores if self.model is not None else S.surrogate_scores(self.providers)
        return materialize(S.ensemble(base.select("npi", "fraud_score_xgb", "fraud_score_iso")), "scores")

    @cached_property
    def providers_scored(self) -> DataFrame:
        """J2+J3: providers LEFT JOIN feature subset LEFT JOIN scores (scores win)."""
        p = self.providers.drop(*[c for c in SCORE_COLUMNS if c in self.providers.columns])
        f = self.features.select("npi", *SCORED_FEATURE_COLUMNS)
        # written once: every catalog and report query reads this table
        return materialize(p.join(growing(f), on="npi", how="left").join(growing(self.scores), on="npi", how="left"),
                           "providers_scored")

    @cached_property
    def provider_years(self) -> DataFrame:
        """Multi-year provider rows: standardised names and ratios (no suppression
        filter -- yearly beneficiary counts are mostly below the threshold)."""
        raw = fixture.provider_years_raw(self.spark, self.sf_dir, self.order_facts)
        df = C.add_ratios(C.standardize_specialty(C.valid_npi(raw)))
        return materialize(C.to_provider_table(df, data_year=None))

    @cached_property
    def exclusions(self) -> DataFrame:
        return materialize(fixture.exclusions_from_tables(self.spark, self.sf_dir))

    @cached_property
    def reasons(self) -> DataFrame:
        """Top-k providers by ensemble score with their three strongest reasons."""
        if self.model is not None:
            return self.model.reasons
        top = S.top_k_by_score(self.providers_scored.select("npi", "fraud_score_ensemble"))
        attr, feats = S.surrogate_attributions(self.features.join(top.select("npi"), "npi", "left_semi"))
        return materialize(S.top_reasons(attr, feats))

    @property
    def alerts(self) -> DataFrame:
        return S.alerts_table(self.providers_scored, self.reasons)

    def build_all(self, parallelism: int = 4) -> Workspace:
        """Materialise every view; independent views run as concurrent Spark jobs."""
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            side = [pool.submit(lambda: self.exclusions)]
            _ = self.order_facts
            side.append(pool.submit(lambda: self.provider_years))
            _ = self.providers
            deps = [pool.submit(lambda: self._bench_and_features), pool.submit(lambda: self.scores)]
            for f in deps:
                f.result()
            _ = self.providers_scored
            _ = self.reasons
            for f in side:
                f.result()
        return self


_LOCK = threading.Lock()
_CACHE: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    """Shared workspace for this application and folder."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext handle
        app = str(id(spark))
    key = (app, sf_dir.rstrip("/"))
    with _LOCK:
        ws = _CACHE.get(key)
        if ws is None:
            ws = _CACHE[key] = Workspace(spark, sf_dir)
        return ws


def register_views(ws: Workspace) -> None:
    """Expose the views to ``spark.sql`` under their table names."""
    ws.providers_scored.createOrReplaceTempView("providers")
    ws.provider_features.createOrReplaceTempView("provider_features")
    ws.benchmarks.createOrReplaceTempView("specialty_benchmarks")
    ws.exclusions.createOrReplaceTempView("oig_exclusions")
    ws.alerts.createOrReplaceTempView("fraud_alerts")
    ws.provider_years.createOrReplaceTempView("provider_years")

