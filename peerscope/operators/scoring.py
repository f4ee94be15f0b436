"""Scores, ensemble, tiers, top-k reasons and confirmation against the exclusion list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscope.functions import growing, round_half_even
from peerscope.operators.ordered import ordered_stats
from peerscope.operators.peers import long_metrics

# Ensemble weights, tier cut-offs (>=) and tier order.
W_SUPERVISED = 0.60
W_UNSUPERVISED = 0.40
TIER_CUTS = [("CRITICAL", 0.80), ("HIGH", 0.60), ("MODERATE", 0.40)]
TIER_ORDER = ["CRITICAL", "HIGH", "MODERATE", "LOW"]
REASONS_TOP_K = 500


def global_pct_ranks(df: DataFrame, metrics: Sequence[str], key: str = "npi") -> DataFrame:
    """pandas ``rank(pct=True)`` over the whole table for each metric (no group):
    returns ``key`` and ``pct_<metric>`` (unrounded)."""
    metrics = list(metrics)
    long = long_metrics(df, metrics, [key])
    st = ordered_stats(long, ["metric"], "x", ascending=True)
    ranked = long.join(growing(st), on=["metric", "x"], how="inner")
    pct = (F.col("n_before") + (F.col("n") + F.lit(1)) / F.lit(2.0)) / F.col("n_total")
    return (ranked.select(key, "metric", pct.alias("pct"))
            .groupBy(key).pivot("metric", metrics).agg(F.first("pct"))
            .select(key, *[F.col(m).alias(f"pct_{m}") for m in metrics]))


def surrogate_scores(providers: DataFrame, key: str = "npi") -> DataFrame:
    """Stand-in model scores for checkable runs: supervised = global percentile
    rank of claim count, unsupervised = global percentile rank of drug cost."""
    r = global_pct_ranks(providers, ["total_claim_count", "total_drug_cost"], key)
    return r.select(key, F.col("pct_total_claim_count").alias("fraud_score_xgb"),
                    F.col("pct_total_drug_cost").alias("fraud_score_iso"))


def minmax_scale(df: DataFrame, column: str, out: str, flip: bool = False) -> DataFrame:
    """M6: scale to [0, 1] by the global min and max (constant column -> 0);
    ``flip`` negates first (higher raw = less anomalous)."""
    v = -F.col(column) if flip else F.col(column)
    tmp = df.withColumn("_v", v)
    bounds = tmp.agg(F.min("_v").alias("_mn"), F.max("_v").alias("_mx"))
    # one row: broadcasting it is bounded by construction
    scaled = tmp.crossJoin(F.broadcast(bounds))
    rng = F.col("_mx") - F.col("_mn")
    return scaled.withColumn(out, F.when(rng == 0, F.lit(0.0)).otherwise((F.col("_v") - F.col("_mn")) / rng)
                             ).drop("_v", "_mn", "_mx")


def tier_of(score: Column, cuts=TIER_CUTS, default: str = "LOW") -> Column:
    """M7 tiers with ``>=`` comparisons; NULL scores fall to the default tier."""
    expr = None
    for name, cut in cuts:
        cond = score >= F.lit(float(cut))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(default))


def ensemble(scores: DataFrame, w_sup: float = W_SUPERVISED, w_unsup: float = W_UNSUPERVISED) -> DataFrame:
    """M7: weighted blend of the two scores and its tier."""
    e = F.lit(float(w_sup)) * F.col("fraud_score_xgb") + F.lit(float(w_unsup)) * F.col("fraud_score_iso")
    return (scores.withColumn("fraud_score_ensemble", e)
            .withColumn("fraud_tier", tier_of(F.col("fraud_score_ensemble"))))


def tier_rank(tier: Column) -> Column:
    """Position of a tier in the fixed order (CRITICAL=1 ... anything else=4)."""
    return (F.when(tier == "CRITICAL", 1).when(tier == "HIGH", 2)
            .when(tier == "MODERATE", 3).otherwise(4))


def top_reasons(attributions: DataFrame, features: Sequence[str], key: str = "npi",
                value_prefix: str = "v_", impact_prefix: str = "i_", k: int = 3) -> DataFrame:
    """M9: the ``k`` features with the largest absolute impact, rendered as
    ``"<feature>: <value %.2f> (impact <%+.3f>)"`` in ``reason_1..k``.

    ``attributions`` holds, per row, ``v_<f>`` (feature value) and ``i_<f>``
    (impact).  Ties in |impact| keep the feature order.  Values are pre-rounded
    half-even so the text matches Python formatting.
    """
    items = F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(f).alias("feature"),
                 F.col(f"{value_prefix}{f}").cast("double").alias("value"),
                 F.col(f"{impact_prefix}{f}").cast("double").alias("impact"))
        for i, f in enumerate(features)])
    ordered = F.array_sort(items, lambda a, b: F.when(F.abs(a.impact) > F.abs(b.impact), -1)
                           .when(F.abs(a.impact) < F.abs(b.impact), 1)
                           .when(a.pos < b.pos, -1).when(a.pos > b.pos, 1).otherwise(0))
    top = attributions.select(key, F.slice(ordered, 1, k).alias("_top"))
    cols = [key]
    for i in range(k):
        it = F.col("_top")[i]
        txt = F.format_string("%s: %.2f (impact %+.3f)", it.feature,
                              round_half_even(it.value, 2), round_half_even(it.impact, 3))
        cols.append(txt.alias(f"reason_{i + 1}"))
    return top.select(*cols)


def top_k_by_score(scored: DataFrame, k: int = REASONS_TOP_K, score: str = "fraud_score_ensemble",
                   key: str = "npi") -> DataFrame:
    """The ``k`` highest scores (ties broken by key).  Top-k without a full
    sort: each task keeps its best ``k`` and the driver-side merge handles ``k``
    rows per task."""
    return scored.orderBy(F.col(score).desc_nulls_last(), F.col(key).asc()).limit(k)


def surrogate_attributions(features: DataFrame, key: str = "npi") -> tuple[DataFrame, list[str]]:
    """Stand-in attribution for checkable runs: each peer z-score is its own
    feature value and impact (a provider is explained by how far it sits from
    its peers)."""
    feats = ["z_total_claim_count", "z_total_drug_cost", "z_cost_per_claim",
             "z_brand_share", "z_opioid_share", "z_claims_per_bene"]
    cols = [key]
    for f in feats:
        cols += [F.coalesce(F.col(f), F.lit(0.0)).alias(f"v_{f}"), F.coalesce(F.col(f), F.lit(0.0)).alias(f"i_{f}")]
    return features.select(*cols), feats


def alerts_table(scored: DataFrame, reasons: DataFrame, key: str = "npi",
                 model_version: str = "peerscope-1") -> DataFrame:
    """Alert rows: reasons joined with score and tier, stamped with a version."""
    return (reasons.join(scored.select(key, "fraud_score_ensemble", "fraud_tier"), on=key, how="inner")
            .select(key, "reason_1", "reason_2", "reason_3",
                    F.col("fraud_score_ensemble").alias("fraud_score"), F.col("fraud_tier").alias("tier"),
                    F.current_timestamp().alias("alert_date"), F.lit(model_version).alias("model_version")))


def critical_confirmation(scored: DataFrame, label: str = "is_fraud_label", tier: str = "CRITICAL") -> DataFrame:
    """A10: providers in the tier, how many carry the label, and the rate in %
    (0 when the tier is empty)."""
    return scored.agg(
        F.count_if(F.col("fraud_tier") == tier).alias("n_critical"),
        F.count_if((F.col("fraud_tier") == tier) & (F.col(label) == 1)).alias("n_confirmed"),
    ).select("n_critical", "n_confirmed",
             F.coalesce(round_half_even(F.lit(100.0) * F.col("n_confirmed") / F.nullif(F.col("n_critical"), F.lit(0)), 1),
                        F.lit(0.0)).alias("confirmation_pct"))
