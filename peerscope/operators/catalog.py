"""The investigative query catalog (F1-F8, I1-I6 and the two README queries).

Each function takes the provider views and the query's thresholds (defaults
are the catalog's values) and returns a DataFrame.  Window semantics follow
the SQL text: a query's WHERE runs before its windows, except F1 whose
filter is on the windowed value itself.

Partition-wide window aggregates (``AVG/STDDEV OVER (PARTITION BY g)``) are
computed as a grouped aggregate joined back on ``g`` (NULL-safe), and
``RANK() OVER (PARTITION BY g ORDER BY x)`` from ``ordered_stats``: neither
puts a whole peer group into one task.  LAG over a provider's years uses a
window -- a provider holds only a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerscope.functions import bounded_broadcast, exact_mean, join_null_safe, money_sum, round_half_even
from peerscope.operators.ordered import ordered_stats
from peerscope.operators.scoring import tier_rank


def _name() -> F.Column:
    # SQL ``||`` propagates NULL, as does concat
    return F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("provider_name")


def _group_stats(df: DataFrame, keys: list[str], aggs: list[F.Column]) -> DataFrame:
    """Attach whole-partition aggregates to each row (window without ORDER BY)."""
    # one row per group: broadcast behind a size check, so a hot specialty or state is not shuffled
    return join_null_safe(df, bounded_broadcast(df.groupBy(*keys).agg(*aggs)), keys, how="inner")


def _rank_desc(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """``RANK() OVER (PARTITION BY keys ORDER BY value DESC)`` for every row."""
    st = ordered_stats(df, keys, value, ascending=False).select(*keys, value, (F.col("n_before") + 1).alias(out))
    return join_null_safe(df, st, [*keys, value], how="left")


def peer_outliers(providers: DataFrame, z_min: float = 3.0, limit: int = 50) -> DataFrame:
    """providers whose claim volume is more than ``z_min`` sample standard
    deviations above their specialty mean (peer stats over all providers)."""
    s = _group_stats(providers, ["specialty"], [
        F.avg("total_claim_count").alias("_avg_c"), F.stddev_samp("total_claim_count").alias("_sd_c"),
        F.avg("cost_per_claim").alias("_avg_k"), F.stddev_samp("cost_per_claim").alias("_sd_k")])
    out = s.select(
        "npi", _name(), "state", "specialty", "total_claim_count", "total_drug_cost", "cost_per_claim",
        round_half_even("_avg_c", 0).alias("specialty_avg_claims"),
        round_half_even((F.col("total_claim_count") - F.col("_avg_c")) / F.nullif("_sd_c", F.lit(0.0)), 2)
        .alias("z_score_claims"),
        round_half_even((F.col("cost_per_claim") - F.col("_avg_k")) / F.nullif("_sd_k", F.lit(0.0)), 2)
        .alias("z_score_cost_per_claim"))
    return (out.where(F.col("z_score_claims") > F.lit(float(z_min)))
            .orderBy(F.col("z_score_claims").desc(), "npi").limit(limit))


def brand_heavy(providers: DataFrame, share_min: float = 0.75, claims_min: int = 500, limit: int = 50) -> DataFrame:
    """brand share above ``share_min`` with more than ``claims_min`` claims;
    specialty averages over the filtered rows."""
    f = providers.where((F.col("brand_share") > F.lit(float(share_min)))
                        & (F.col("total_claim_count") > F.lit(claims_min)))
    s = _group_stats(f, ["specialty"], [exact_mean("brand_share", 4).alias("_avg_b")])
    return (s.select("npi", _name(), "specialty", "state", "brand_share", "total_drug_cost", "total_claim_count",
                     round_half_even("_avg_b", 3).alias("specialty_avg_brand_share"),
                     round_half_even(F.col("brand_share") - F.col("_avg_b"), 3).alias("brand_share_above_avg"))
            .orderBy(F.col("brand_share").desc(), "npi").limit(limit))


def concentrated_beneficiaries(providers: DataFrame, claims_min: int = 200, limit: int = 50) -> DataFrame:
    """many claims per beneficiary; specialty average and rank over the
    rows with more than ``claims_min`` claims."""
    f = providers.where(F.col("total_claim_count") > F.lit(claims_min))
    s = _group_stats(f, ["specialty"], [exact_mean("claims_per_bene", 2).alias("_avg_cpb")])
    s = _rank_desc(s, ["specialty"], "claims_per_bene", "rank_within_specialty")
    return (s.select("npi", _name(), "specialty", "state", "total_claim_count", "total_beneficiaries",
                     "claims_per_bene", round_half_even("_avg_cpb", 2).alias("specialty_avg_cpb"),
                     F.col("rank_within_specialty").cast("bigint").alias("rank_within_specialty"))
            .orderBy(F.col("claims_per_bene").desc(), "npi").limit(limit))


def _yoy(years: DataFrame, growth_min: float, this: str, prior: str, pct: str) -> DataFrame:
    w = Window.partitionBy("npi").orderBy("data_year")
    y = years.select("npi", "specialty", "data_year", F.col("total_claim_count").alias(this),
                     F.lag("total_claim_count").over(w).alias(prior))
    growth = (F.col(this) - F.col(prior)) / F.nullif(F.col(prior).cast("double"), F.lit(0.0))
    return (y.where(F.col(prior).isNotNull() & (growth > F.lit(float(growth_min))))
            .select("npi", "specialty", "data_year", this, prior,
                    round_half_even(F.lit(100.0) * (F.col(this) - F.col(prior))
                                    / F.nullif(F.col(prior).cast("double"), F.lit(0.0)), 1).alias(pct))
            .orderBy(F.col(pct).desc(), "npi", "data_year"))


def yoy_velocity(provider_years: DataFrame, growth_min: float = 2.0) -> DataFrame:
    """claim growth over the previous available year above ``growth_min``
    (true division: 2.0 means more than +200 %)."""
    return _yoy(provider_years, growth_min, "total_claim_count", "prior_year_claims", "yoy_growth_pct")


def opioid_by_state(providers: DataFrame, claims_min: int = 100, share_min: float = 0.20) -> DataFrame:
    """opioid-heavy providers ranked inside their state (over the filtered rows)."""
    f = providers.where((F.col("total_claim_count") > F.lit(claims_min))
                        & (F.col("opioid_share") > F.lit(float(share_min))))
    s = _group_stats(f, ["state"], [exact_mean("opioid_share", 4).alias("_avg_o")])
    s = _rank_desc(s, ["state"], "opioid_share", "state_opioid_rank")
    return (s.select("state", "specialty", "npi", _name(), "opioid_share", "opioid_claim_count", "total_claim_count",
                     F.col("state_opioid_rank").cast("bigint").alias("state_opioid_rank"),
                     round_half_even("_avg_o", 3).alias("state_avg_opioid_share"))
            .orderBy("state", F.col("opioid_share").desc(), "npi"))


def multi_flag(providers: DataFrame, features: DataFrame, flags_min: int = 3, limit: int = 100) -> DataFrame:
    """providers hitting at least ``flags_min`` of the five signals."""
    p = providers.select("npi", "first_name", "last_name", "specialty", "state", "total_drug_cost",
                         "fraud_score_ensemble", "fraud_tier")
    f = features.select("npi", "flag_count", "flag_high_volume", "flag_high_cost_per_claim", "flag_brand_heavy",
                        "flag_concentrated_benes", "flag_opioid_heavy").where(F.col("flag_count") >= flags_min)
    j = p.join(f, on="npi", how="inner")
    return (j.select("npi", _name(), "specialty", "state", "total_drug_cost", "flag_count", "flag_high_volume",
                     "flag_high_cost_per_claim", "flag_brand_heavy", "flag_concentrated_benes", "flag_opioid_heavy",
                     "fraud_score_ensemble", "fraud_tier")
            .orderBy(F.col("flag_count").desc(), F.col("fraud_score_ensemble").desc(), "npi").limit(limit))


def state_concentration(providers: DataFrame) -> DataFrame:
    """per state -- providers, HIGH+CRITICAL count and %, cost in millions,
    mean ensemble score (scored providers only)."""
    hi = F.col("fraud_tier").isin("HIGH", "CRITICAL")
    g = providers.where(F.col("fraud_tier").isNotNull()).groupBy("state").agg(
        F.count(F.lit(1)).alias("total_providers"),
        F.count_if(hi).alias("high_risk_count"),
        money_sum("total_drug_cost").alias("_cost"),
        F.avg("fraud_score_ensemble").alias("_avg"))
    return (g.select("state", "total_providers", "high_risk_count",
                     round_half_even(F.lit(100.0) * F.col("high_risk_count") / F.col("total_providers"), 2)
                     .alias("high_risk_pct"),
                     round_half_even(F.col("_cost") / F.lit(1e6), 1).alias("total_cost_M"),
                     round_half_even("_avg", 3).alias("avg_fraud_score"))
            .orderBy(F.col("high_risk_pct").desc(), "state"))


def oig_by_tier(providers: DataFrame, exclusions: DataFrame, dedupe: bool = True) -> DataFrame:
    """F8: per tier, providers and how many appear on the exclusion list.

    ``dedupe=True`` (default) counts a provider once however many exclusion
    dates it has (semi-join semantics); ``dedupe=False`` keeps the catalog's
    plain LEFT JOIN, where several dates fan a provider out."""
    ex = exclusions.select("npi").where(F.col("npi").isNotNull())
    ex = ex.distinct() if dedupe else ex
    j = providers.select("npi", "fraud_tier").join(
        ex.select(F.col("npi").alias("_ex_npi")), F.col("npi") == F.col("_ex_npi"), "left")
    g = j.groupBy("fraud_tier").agg(F.count(F.lit(1)).alias("total_in_tier"),
                                    F.count_if(F.col("_ex_npi").isNotNull()).alias("oig_confirmed"))
    return (g.select("fraud_tier", "total_in_tier", "oig_confirmed",
                     round_half_even(F.lit(100.0) * F.col("oig_confirmed") / F.col("total_in_tier"), 2)
                     .alias("oig_match_pct"))
            .orderBy(tier_rank(F.col("fraud_tier")), "fraud_tier"))


def small_pool_high_volume(providers: DataFrame, benes_max: int = 50, claims_min: int = 200) -> DataFrame:
    """C15 (the I1 pool CTE): few beneficiaries but many claims."""
    return (providers.where((F.col("total_beneficiaries") < benes_max) & (F.col("total_claim_count") > claims_min))
            .select("npi", "specialty", "total_beneficiaries", "total_claim_count", "claims_per_bene"))


def shared_pool_candidates(providers: DataFrame, features: DataFrame, limit: int = 50) -> DataFrame:
    """Providers flagged both for concentrated beneficiaries and volume,
    with their tier, by claims per beneficiary (true division)."""
    f = features.where((F.col("flag_concentrated_benes") == 1) & (F.col("flag_high_volume") == 1)).select(
        "npi", "flag_count")
    p = providers.select("npi", "specialty", "fraud_score_ensemble", "total_beneficiaries", "total_claim_count",
                         "fraud_tier")
    j = p.join(f, on="npi", how="inner")
    return (j.select("npi", "specialty", "flag_count", "fraud_score_ensemble", "total_beneficiaries",
                     "total_claim_count", "fraud_tier")
            .orderBy((F.col("total_claim_count") / F.col("total_beneficiaries")).desc(), "npi").limit(limit))


def specialty_spread(providers: DataFrame, min_providers: int = 50) -> DataFrame:
    """Specialties whose p99 cost is far above the median (groups with more
    than ``min_providers`` rows)."""
    from peerscope.operators.ordered import exact_quantiles
    counts = providers.groupBy("specialty").agg(F.count(F.lit(1)).alias("n_providers"),
                                                exact_mean("total_drug_cost", 2).alias("_avg"))
    counts = counts.where(F.col("n_providers") > min_providers)
    q = exact_quantiles(providers, ["specialty"], "total_drug_cost", {"_p50": 0.5, "_p99": 0.99})
    j = join_null_safe(counts, q, ["specialty"], how="left")
    return (j.select("specialty", "n_providers", round_half_even("_avg", 0).alias("avg_cost"),
                     round_half_even("_p50", 0).alias("median_cost"), round_half_even("_p99", 0).alias("p99_cost"),
                     round_half_even(F.col("_p99") / F.nullif(F.col("_p50"), F.lit(0.0)), 1).alias("p99_to_median_ratio"))
            .orderBy(F.col("p99_to_median_ratio").desc(), "specialty"))


def yoy_surge(provider_years: DataFrame, growth_min: float = 1.0) -> DataFrame:
    """Year-over-year growth above ``growth_min`` (true division)."""
    return _yoy(provider_years, growth_min, "claims_this_yr", "claims_prior_yr", "growth_pct")


def geographic_clustering(providers: DataFrame) -> DataFrame:
    """I4: per state -- CRITICAL density, mean score, total and at-risk cost."""
    crit = F.col("fraud_tier") == "CRITICAL"
    g = providers.groupBy("state").agg(
        F.count(F.lit(1)).alias("total_providers"),
        F.count_if(crit).alias("critical_count"),
        F.avg("fraud_score_ensemble").alias("_avg"),
        money_sum("total_drug_cost").alias("_cost"),
        money_sum(F.when(crit, F.col("total_drug_cost")).otherwise(F.lit(0.0))).alias("_risk"))
    return (g.select("state", "total_providers", "critical_count",
                     round_half_even(F.lit(100.0) * F.col("critical_count") / F.col("total_providers"), 2)
                     .alias("critical_pct"),
                     round_half_even("_avg", 4).alias("avg_ensemble_score"),
                     round_half_even(F.col("_cost") / F.lit(1e6), 1).alias("total_cost_M"),
                     round_half_even(F.col("_risk") / F.lit(1e6), 1).alias("at_risk_cost_M"))
            .orderBy(F.col("critical_pct").desc(), "state"))


# Reason-text patterns and their signal labels, first match wins.
SIGNAL_PATTERNS = [
    ("z_total_claim_count", "Extreme claim volume"),
    ("z_cost_per_claim", "High cost per claim"),
    ("z_brand_share", "Brand-heavy prescribing"),
    ("z_opioid_share", "Opioid overuse"),
    ("flag_count", "Multiple flags combined"),
    ("claims_per_bene", "Concentrated beneficiaries"),
]


def primary_signal(reason: F.Column) -> F.Column:
    expr = None
    for pat, label in SIGNAL_PATTERNS:
        cond = reason.contains(pat)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit("Other"))


def signal_frequency(alerts: DataFrame, providers: DataFrame, tier: str = "CRITICAL") -> DataFrame:
    """Primary signal of the first reason among alerts of the tier, as a
    share of *all* alerts."""
    total = alerts.agg(F.count(F.lit(1)).alias("_all"))
    j = alerts.select("npi", "reason_1").join(
        providers.where(F.col("fraud_tier") == tier).select("npi"), on="npi", how="inner")
    g = j.groupBy(primary_signal(F.col("reason_1")).alias("primary_signal")).agg(
        F.count(F.lit(1)).alias("providers_with_signal"))
    # one-row total: broadcasting it is bounded by construction
    return (g.crossJoin(F.broadcast(total))
            .select("primary_signal", "providers_with_signal",
                    round_half_even(F.lit(100.0) * F.col("providers_with_signal") / F.col("_all"), 1)
                    .alias("pct_of_alerts"))
            .orderBy(F.col("providers_with_signal").desc(), "primary_signal"))


def false_positive_audit(providers: DataFrame, features: DataFrame, tier: str = "CRITICAL",
                         flags_max: int = 2, label: int = 0) -> DataFrame:
    """High-tier providers with few flags and no label -- candidates for review."""
    p = providers.where((F.col("fraud_tier") == tier) & (F.col("is_fraud_label") == label)).select(
        "npi", "specialty", "state", "fraud_score_ensemble", "total_claim_count", "brand_share", "opioid_share",
        "is_fraud_label")
    f = features.where(F.col("flag_count") <= flags_max).select("npi", "flag_count")
    return (p.join(f, on="npi", how="inner")
            .select("npi", "specialty", "state", "fraud_score_ensemble", "flag_count", "total_claim_count",
                    "brand_share", "opioid_share", "is_fraud_label")
            .orderBy(F.col("fraud_score_ensemble").desc(), "npi"))


def zscore_ranking(providers: DataFrame) -> DataFrame:
    """README query 1: claim-count z-score inside the specialty for every provider."""
    s = _group_stats(providers, ["specialty"], [F.avg("total_claim_count").alias("_a"),
                                                F.stddev_samp("total_claim_count").alias("_s")])
    return (s.select("npi", "specialty", "total_claim_count",
                     round_half_even((F.col("total_claim_count") - F.col("_a")) / F.nullif("_s", F.lit(0.0)), 2)
                     .alias("z_score"))
            .orderBy(F.col("z_score").desc_nulls_last(), "npi"))


def label_by_tier(providers: DataFrame) -> DataFrame:
    """README query 2: per tier, providers, labelled providers and the share in %."""
    g = providers.groupBy("fraud_tier").agg(F.count(F.lit(1)).alias("total"),
                                            F.sum("is_fraud_label").cast("bigint").alias("oig_confirmed"))
    return (g.select("fraud_tier", "total", "oig_confirmed",
                     round_half_even(F.lit(100.0) * F.col("oig_confirmed") / F.col("total"), 1)
                     .alias("confirmation_pct"))
            .orderBy(F.col("confirmation_pct").desc(), "fraud_tier"))
