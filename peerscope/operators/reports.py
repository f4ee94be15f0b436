"""Report operators: pipeline summaries and the dashboard aggregates.

All are grouped aggregates over the scored provider view; fixed category
lists (tiers, flag counts, histogram bins) are left-joined so empty
categories still appear.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peerscope.functions import bounded_broadcast, exact_mean, money_sum, round_half_even, stable_hash
from peerscope.operators.ordered import exact_quantiles
from peerscope.operators.peers import FLAG_COLUMNS
from peerscope.operators.scoring import TIER_ORDER, tier_rank

# Flag labels, score-bar colour classes, pattern-table floors.
FLAG_LABELS = [
    ("flag_high_volume", "Extreme claim volume"),
    ("flag_high_cost_per_claim", "High cost per claim"),
    ("flag_brand_heavy", "Brand-heavy prescribing"),
    ("flag_concentrated_benes", "Concentrated patients"),
    ("flag_opioid_heavy", "Opioid overuse"),
]
# Display names of the features that reasons are built from.
FEATURE_LABELS = {
    "z_total_claim_count": "Claim volume vs specialty peers",
    "z_cost_per_claim": "Cost per claim vs specialty peers",
    "z_brand_share": "Brand drug usage vs specialty peers",
    "z_opioid_share": "Opioid prescribing vs specialty peers",
    "flag_high_volume": "Extreme claim volume (top 1% in specialty)",
    "flag_high_cost_per_claim": "High cost per claim (top 1% in specialty)",
    "flag_brand_heavy": "Brand-heavy prescribing (>70% brand)",
    "flag_concentrated_benes": "Concentrated beneficiaries (pill mill pattern)",
    "flag_opioid_heavy": "High opioid share (>20% of claims)",
    "brand_share": "Brand drug share",
    "opioid_share": "Opioid prescription share",
    "cost_per_claim": "Cost per claim (USD)",
    "claims_per_bene": "Claims per beneficiary",
}
SCORE_BAR_CUTS = [("red", 0.8), ("orange", 0.6), ("yellow", 0.4)]   # strict '>'
PATTERN_METRICS = [  # (metric label, column, scale, floor for the ratio denominator)
    ("Brand drug share", "brand_share", 100.0, None),
    ("Opioid share", "opioid_share", 100.0, 0.001),
    ("Cost per claim", "cost_per_claim", 1.0, 1.0),
    ("Claims per patient", "claims_per_bene", 1.0, 0.001),
]
PEER_METRICS = [("total_claim_count", 1.0), ("cost_per_claim", 1.0), ("brand_share", 100.0), ("opioid_share", 100.0)]
# decimals each metric is rounded to at cleaning (exact means use them)
PEER_SCALES = [("total_claim_count", 0), ("cost_per_claim", 2), ("brand_share", 4), ("opioid_share", 4)]
PATTERN_SCALES = {"brand_share": 4, "opioid_share": 4, "cost_per_claim": 2, "claims_per_bene": 2}


def _tiers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t, i + 1) for i, t in enumerate(TIER_ORDER)], "fraud_tier string, tier_order int")


def clean_summary(providers: DataFrame, label: str = "is_fraud_label") -> DataFrame:
    """A2: totals printed after cleaning."""
    return providers.agg(
        F.count(F.lit(1)).alias("total_providers"),
        round_half_even(money_sum("total_drug_cost") / F.lit(1e9), 2).alias("total_cost_b"),
        round_half_even(F.avg("total_claim_count"), 0).alias("avg_claims"),
        round_half_even(exact_mean("cost_per_claim", 2), 0).alias("avg_cost_per_claim"),
        round_half_even(exact_mean("brand_share", 4) * F.lit(100.0), 1).alias("avg_brand_pct"),
        F.sum(label).cast("bigint").alias("fraud_labels"),
        round_half_even(F.lit(100.0) * F.sum(label) / F.count(F.lit(1)), 2).alias("fraud_pct"))


def top_specialties_by_count(providers: DataFrame, k: int = 5) -> DataFrame:
    """A3: the ``k`` most common specialties."""
    return (providers.where(F.col("specialty").isNotNull()).groupBy("specialty")
            .agg(F.count(F.lit(1)).alias("n_providers"))
            .orderBy(F.col("n_providers").desc(), "specialty").limit(k))


def flag_distribution(features: DataFrame) -> DataFrame:
    """A4: providers with 0..5 flags (zeros included) and their share in %."""
    spark = features.sparkSession
    counts = features.groupBy("flag_count").agg(F.count(F.lit(1)).alias("n_providers"))
    total = features.agg(F.count(F.lit(1)).alias("_all"))
    levels = spark.range(len(FLAG_COLUMNS) + 1).select(F.col("id").cast("int").alias("flag_count"))
    j = levels.join(counts, "flag_count", "left").crossJoin(F.broadcast(total))
    n = F.coalesce(F.col("n_providers"), F.lit(0)).cast("bigint")
    return (j.select("flag_count", n.alias("n_providers"),
                     round_half_even(F.lit(100.0) * n / F.col("_all"), 1).alias("pct"))
            .orderBy("flag_count"))


def flag_separation(features: DataFrame, label: str = "is_fraud_label") -> DataFrame:
    """A5: mean flag count for labelled vs unlabelled providers and their ratio."""
    g = features.agg(F.avg(F.when(F.col(label) == 1, F.col("flag_count"))).alias("_f"),
                     F.avg(F.when(F.col(label) == 0, F.col("flag_count"))).alias("_n"))
    return g.select(round_half_even("_f", 2).alias("avg_flags_fraud"), round_half_even("_n", 2).alias("avg_flags_normal"),
                    round_half_even(F.try_divide("_f", "_n"), 1).alias("flag_separation"))


def validation_counts(providers: DataFrame, features: DataFrame, label: str = "is_fraud_label") -> DataFrame:
    """The post-load validation counts, one row."""
    p = providers.agg(F.count(F.lit(1)).alias("total_providers"),
                      F.count_if(F.col(label) == 1).alias("fraud_labels"),
                      F.count_distinct("specialty").alias("specialties"),
                      F.count_distinct("state").alias("states"))
    f = features.agg(F.count(F.lit(1)).alias("feature_rows"),
                     F.count_if(F.col("flag_count") >= 3).alias("providers_3plus_flags"))
    return p.crossJoin(f)


def top_specialties_by_cost(providers: DataFrame, k: int = 5) -> DataFrame:
    """Specialties with the largest total cost (millions, 1 dp)."""
    g = providers.groupBy("specialty").agg(F.count(F.lit(1)).alias("n"), money_sum("total_drug_cost").alias("_c"))
    return (g.select("specialty", "n", round_half_even(F.col("_c") / F.lit(1e6), 1).alias("cost_M"))
            .orderBy(F.col("cost_M").desc(), "specialty").limit(k))


def class_distribution(df: DataFrame, label: str = "is_fraud_label") -> DataFrame:
    """Rows per class, share in %, and the imbalance ratio n0/n1 (the
    positive-class weight)."""
    g = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    tot = df.agg(F.count(F.lit(1)).alias("_all"), F.count_if(F.col(label) == 0).alias("_n0"),
                 F.count_if(F.col(label) == 1).alias("_n1"))
    return (g.crossJoin(F.broadcast(tot))
            .select("label", "n", round_half_even(F.lit(100.0) * F.col("n") / F.col("_all"), 1).alias("pct"),
                    round_half_even(F.try_divide(F.col("_n0").cast("double"), F.col("_n1")), 4).alias("imbalance_ratio"))
            .orderBy("label"))


def tier_distribution(scored: DataFrame) -> DataFrame:
    """Providers per tier in the fixed order (empty tiers shown with 0)."""
    counts = scored.groupBy("fraud_tier").agg(F.count(F.lit(1)).alias("n"))
    total = scored.agg(F.count(F.lit(1)).alias("_all"))
    j = _tiers(scored.sparkSession).join(counts, "fraud_tier", "left").crossJoin(F.broadcast(total))
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    return (j.select("fraud_tier", "tier_order", n.alias("n_providers"),
                     round_half_even(F.lit(100.0) * n / F.col("_all"), 1).alias("pct"))
            .orderBy("tier_order"))


def overview_headline(scored: DataFrame) -> DataFrame:
    """Headline numbers of the landing page."""
    risk = F.col("fraud_tier").isin("CRITICAL", "HIGH")
    return scored.agg(
        F.count(F.lit(1)).alias("total_providers"),
        F.count_if(F.col("fraud_tier") == "CRITICAL").alias("n_critical"),
        F.count_if(F.col("fraud_tier") == "HIGH").alias("n_high"),
        round_half_even(money_sum("total_drug_cost") / F.lit(1e9), 2).alias("total_cost_b"),
        round_half_even(F.coalesce(money_sum(F.when(risk, F.col("total_drug_cost"))), F.lit(0.0)) / F.lit(1e6), 0)
        .alias("at_risk_cost_m"))


def score_histogram(scored: DataFrame, bins: int = 50, score: str = "fraud_score_ensemble") -> DataFrame:
    """Counts in ``bins`` equal-width bins over [0, 1] (last bin closed)."""
    b = F.least(F.floor(F.col(score) * F.lit(float(bins))), F.lit(bins - 1)).cast("int")
    counts = scored.where(F.col(score).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    levels = scored.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    j = levels.join(counts, "bin", "left")
    return (j.select("bin", (F.col("bin") / F.lit(float(bins))).alias("bin_lo"),
                     ((F.col("bin") + 1) / F.lit(float(bins))).alias("bin_hi"),
                     F.coalesce("n", F.lit(0)).cast("bigint").alias("n_providers"))
            .orderBy("bin"))


def top_flagged_specialties(scored: DataFrame, k: int = 10, tiers: Sequence[str] = ("CRITICAL", "HIGH")) -> DataFrame:
    """Specialties with most providers in the given tiers."""
    return (scored.where(F.col("fraud_tier").isin(*tiers) & F.col("specialty").isNotNull())
            .groupBy("specialty").agg(F.count(F.lit(1)).alias("flagged_providers"))
            .orderBy(F.col("flagged_providers").desc(), "specialty").limit(k))


def _peer_means(scored: DataFrame, min_peers: int) -> DataFrame:
    """One row per specialty with more than ``min_peers`` providers: exact means of the compared metrics."""
    means = scored.where(F.col("specialty").isNotNull()).groupBy("specialty").agg(
        F.count(F.lit(1)).alias("_n"), *[exact_mean(m, d).alias(f"_avg_{m}") for m, d in PEER_SCALES])
    return means.where(F.col("_n") > min_peers)


def peer_comparison(scored: DataFrame, min_peers: int = 10, npi: str | None = None) -> DataFrame:
    """Provider value vs specialty mean (self included) for four metrics,
    shares in %, only for specialties with more than ``min_peers`` providers.
    Long format, one row per (provider, metric); ``npi`` restricts to one provider."""
    means = _peer_means(scored, min_peers)
    rows = scored if npi is None else scored.where(F.col("npi") == F.lit(npi.strip()))
    j = rows.join(bounded_broadcast(means), "specialty", "inner")
    items = F.array(*[F.struct(F.lit(m).alias("metric"),
                               (F.col(m) * F.lit(s)).alias("provider_value"),
                               (F.col(f"_avg_{m}") * F.lit(s)).alias("peer_avg")) for m, s in PEER_METRICS])
    return (j.select("npi", "specialty", F.inline(items))
            .select("npi", "specialty", "metric", round_half_even("provider_value", 4).alias("provider_value"),
                    round_half_even("peer_avg", 4).alias("peer_avg")))


def filter_high_risk(scored: DataFrame, tiers: Sequence[str] = ("CRITICAL", "HIGH"),
                     states: Sequence[str] = (), specialties: Sequence[str] = ()) -> DataFrame:
    """C14: tier IN list; state / specialty IN lists only when non-empty."""
    out = scored.where(F.col("fraud_tier").isin(*tiers))
    if states:
        out = out.where(F.col("state").isin(*states))
    if specialties:
        out = out.where(F.col("specialty").isin(*specialties))
    return out


def high_risk_top(scored: DataFrame, k: int = 100, **filters) -> DataFrame:
    """Filtered providers, highest scores first, top ``k``."""
    return filter_high_risk(scored, **filters).orderBy(F.col("fraud_score_ensemble").desc(), "npi").limit(k)


def high_risk_cards(scored: DataFrame, k: int = 100, **filters) -> DataFrame:
    """Summary cards over the filtered top-``k``."""
    top = high_risk_top(scored, k, **filters)
    return top.agg(F.count(F.lit(1)).alias("n_providers"),
                   round_half_even(F.coalesce(money_sum("total_drug_cost"), F.lit(0.0)) / F.lit(1e6), 1).alias("total_cost_m"),
                   round_half_even(F.avg("fraud_score_ensemble"), 3).alias("avg_score"),
                   F.sum("is_fraud_label").cast("bigint").alias("oig_confirmed"),
                   round_half_even(F.avg("flag_count"), 1).alias("avg_flags"))


def high_risk_table(scored: DataFrame, k: int = 100, **filters) -> DataFrame:
    """The formatted high-risk table (text columns as displayed)."""
    top = high_risk_top(scored, k, **filters)
    return top.select(
        F.col("npi").alias("NPI"), F.col("first_name").alias("First"), F.col("last_name").alias("Last"),
        F.col("specialty").alias("Specialty"), F.col("state").alias("State"), F.col("fraud_tier").alias("Tier"),
        F.format_string("%.4f", round_half_even("fraud_score_ensemble", 4)).alias("Score"),
        F.col("total_claim_count").alias("Claims"),
        F.format_string("$%.0fK", round_half_even(F.col("total_drug_cost") / F.lit(1000.0), 0)).alias("Drug_Cost"),
        F.format_string("$%.0f", round_half_even("cost_per_claim", 0)).alias("Cost_per_Claim"),
        F.format_string("%.1f%%", round_half_even(F.col("brand_share") * F.lit(100.0), 1)).alias("Brand_pct"),
        F.format_string("%.1f%%", round_half_even(F.col("opioid_share") * F.lit(100.0), 1)).alias("Opioid_pct"),
        F.col("flag_count").alias("Flags"),
        F.when(F.col("is_fraud_label") == 1, F.lit("OIG Confirmed")).otherwise(F.lit("")).alias("OIG_Status"))


def state_display(scored: DataFrame, sort_by: str = "high_risk_pct") -> DataFrame:
    """The state table as displayed (text columns), in the order of ``state_table``."""
    return state_table(scored, sort_by).select(
        "rank", F.col("state").alias("State"), F.col("total_providers").alias("Providers"), F.col("critical_count").alias("CRITICAL"),
        F.col("high_count").alias("HIGH"),
        F.format_string("%.1f%%", round_half_even("high_risk_pct", 1)).alias("High_Risk_pct"),
        F.format_string("%.4f", F.col("avg_fraud_score")).alias("Avg_Score"),
        F.format_string("$%.1fM", F.col("total_drug_cost_m")).alias("Drug_Cost"),
        F.col("oig_confirmed").alias("OIG_Confirmed"))


def lookup_metrics(scored: DataFrame) -> DataFrame:
    """The billing metrics of the lookup page as displayed, one row per provider and metric; NULL counts as 0."""
    def v(c):
        return F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    shown = [("Total Claims", F.format_number(v("total_claim_count").cast("long"), 0)),
             ("Total Drug Cost", F.format_string("$%.0fK", round_half_even(v("total_drug_cost") / F.lit(1000.0), 0))),
             ("Cost per Claim", F.format_string("$%.0f", round_half_even(v("cost_per_claim"), 0))),
             ("Brand Drug Share", F.format_string("%.1f%%", round_half_even(v("brand_share") * F.lit(100.0), 1))),
             ("Opioid Share", F.format_string("%.1f%%", round_half_even(v("opioid_share") * F.lit(100.0), 1)))]
    items = F.array(*[F.struct(F.lit(n).alias("metric"), x.alias("value")) for n, x in shown])
    return scored.select("npi", F.inline(items))


def labelled_reasons(alerts: DataFrame) -> DataFrame:
    """2.8.16: the feature behind each provider's first reason with its display name (the raw name where there is none)."""
    names = F.create_map(*[F.lit(x) for pair in FEATURE_LABELS.items() for x in pair])
    feature = F.substring_index("reason_1", ":", 1)
    return alerts.select("npi", feature.alias("feature"), F.coalesce(F.try_element_at(names, feature), feature).alias("label"))


def flagged_by_state(scored: DataFrame, k: int = 15, tiers: Sequence[str] = ("CRITICAL", "HIGH"),
                     states: Sequence[str] = ()) -> DataFrame:
    """Flagged providers per state (tier and state filters only), top ``k``."""
    f = scored.where(F.col("fraud_tier").isin(*tiers) & F.col("state").isNotNull())
    if states:
        f = f.where(F.col("state").isin(*states))
    return (f.groupBy("state").agg(F.count(F.lit(1)).alias("n_flagged"))
            .orderBy(F.col("n_flagged").desc(), "state").limit(k))


STATE_SORT_COLUMNS = {"high_risk_pct", "critical_count", "avg_fraud_score", "total_drug_cost_m"}


def _state_rows(scored: DataFrame) -> DataFrame:
    """One row per state (NULL dropped)."""
    g = scored.where(F.col("state").isNotNull()).groupBy("state").agg(
        F.count(F.lit(1)).alias("total_providers"),
        F.count_if(F.col("fraud_tier") == "CRITICAL").alias("critical_count"),
        F.count_if(F.col("fraud_tier") == "HIGH").alias("high_count"),
        F.avg("fraud_score_ensemble").alias("_avg"),
        money_sum("total_drug_cost").alias("_cost"),
        F.sum("is_fraud_label").cast("bigint").alias("oig_confirmed"))
    return g.select("state", "total_providers", "critical_count", "high_count",
                 round_half_even("_avg", 4).alias("avg_fraud_score"),
                 round_half_even(F.col("_cost") / F.lit(1e6), 1).alias("total_drug_cost_m"),
                 "oig_confirmed",
                 round_half_even(F.lit(100.0) * (F.col("critical_count") + F.col("high_count"))
                                 / F.col("total_providers"), 2).alias("high_risk_pct"),
                 (F.col("critical_count") + F.col("high_count")).alias("high_risk_total"))


def state_table(scored: DataFrame, sort_by: str = "high_risk_pct") -> DataFrame:
    """A23 + W10: per state (NULL dropped) counts, mean score, cost, labels,
    high-risk % and a 1-based rank by the chosen metric (ties by state name).
    The ranked table has one row per state, so its one-task window is bounded."""
    if sort_by not in STATE_SORT_COLUMNS:
        raise ValueError(f"sort_by must be one of {sorted(STATE_SORT_COLUMNS)}")
    order = Window.orderBy(F.col(sort_by).desc(), "state")
    return _state_rows(scored).withColumn("rank", F.row_number().over(order).cast("long")).orderBy("rank")


def brand_share_box(scored: DataFrame) -> DataFrame:
    """Five-number summary and mean of brand share (%) per tier, NULLs dropped."""
    s = scored.where(F.col("brand_share").isNotNull()).withColumn("_b", F.col("brand_share") * F.lit(100.0))
    q = exact_quantiles(s, ["fraud_tier"], "_b", {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0})
    m = s.groupBy("fraud_tier").agg((exact_mean("brand_share", 4) * F.lit(100.0)).alias("_mean"),
                                    F.count(F.lit(1)).alias("n"))
    j = m.join(q, "fraud_tier", "inner")
    cols = ["fraud_tier", "n"] + [round_half_even(c, 4).alias(c) for c in ["min", "q1", "median", "q3", "max"]]
    return j.select(*cols, round_half_even("_mean", 4).alias("mean")).orderBy(tier_rank(F.col("fraud_tier")))


def brand_share_by_tier(scored: DataFrame) -> DataFrame:
    """Mean and median brand share (%) per tier in the fixed order."""
    q = exact_quantiles(scored, ["fraud_tier"], "brand_share", {"_med": 0.5})
    m = scored.groupBy("fraud_tier").agg(exact_mean("brand_share", 4).alias("_mean"))
    j = _tiers(scored.sparkSession).join(m, "fraud_tier", "left").join(q, "fraud_tier", "left")
    return (j.select("fraud_tier", "tier_order",
                     round_half_even(F.col("_mean") * F.lit(100.0), 4).alias("mean_pct"),
                     round_half_even(F.col("_med") * F.lit(100.0), 4).alias("median_pct"))
            .orderBy("tier_order"))


def opioid_by_specialty(scored: DataFrame) -> DataFrame:
    """Mean opioid share (%) per specialty, highest first."""
    return (scored.groupBy("specialty").agg(round_half_even(exact_mean("opioid_share", 4) * F.lit(100.0), 4)
                                            .alias("opioid_pct"))
            .orderBy(F.col("opioid_pct").desc(), "specialty"))


def cost_per_claim_by_tier(scored: DataFrame) -> DataFrame:
    """Mean and p95 of cost per claim per tier in the fixed order."""
    q = exact_quantiles(scored, ["fraud_tier"], "cost_per_claim", {"_p95": 0.95})
    m = scored.groupBy("fraud_tier").agg(exact_mean("cost_per_claim", 2).alias("_mean"))
    j = _tiers(scored.sparkSession).join(m, "fraud_tier", "left").join(q, "fraud_tier", "left")
    return (j.select("fraud_tier", "tier_order", round_half_even("_mean", 4).alias("avg_cost_per_claim"),
                     round_half_even("_p95", 4).alias("p95_cost_per_claim"))
            .orderBy("tier_order"))


def pattern_table(scored: DataFrame, normal_tier: str = "LOW", fraud_tier: str = "CRITICAL") -> DataFrame:
    """Normal-tier vs fraud-tier means of four metrics and their ratio
    (denominator floored per metric); empty when either tier is empty."""
    aggs = [F.count_if(F.col("fraud_tier") == normal_tier).alias("_nn"),
            F.count_if(F.col("fraud_tier") == fraud_tier).alias("_nf")]
    for _, c, _, _ in PATTERN_METRICS:
        d = PATTERN_SCALES[c]
        aggs += [exact_mean(F.when(F.col("fraud_tier") == normal_tier, F.col(c)), d).alias(f"_n_{c}"),
                 exact_mean(F.when(F.col("fraud_tier") == fraud_tier, F.col(c)), d).alias(f"_f_{c}")]
    g = scored.agg(*aggs).where((F.col("_nn") > 0) & (F.col("_nf") > 0))
    items = []
    for i, (label, c, scale, floor) in enumerate(PATTERN_METRICS):
        den = F.col(f"_n_{c}") if floor is None else F.greatest(F.col(f"_n_{c}"), F.lit(floor))
        items.append(F.struct(F.lit(i + 1).alias("pos"), F.lit(label).alias("metric"),
                              (F.col(f"_n_{c}") * F.lit(scale)).alias("normal"),
                              (F.col(f"_f_{c}") * F.lit(scale)).alias("fraud"),
                              (F.col(f"_f_{c}") / den).alias("ratio")))
    return (g.select(F.inline(F.array(*items)))
            .select("pos", "metric", round_half_even("normal", 4).alias("normal"),
                    round_half_even("fraud", 4).alias("fraud"), round_half_even("ratio", 4).alias("ratio"))
            .orderBy("pos"))


def distinct_values(scored: DataFrame, column: str) -> DataFrame:
    """Sorted non-null distinct values of a column."""
    return scored.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def isolation_only(scored: DataFrame, sup_max: float | DataFrame, iso_min: float = 0.80) -> DataFrame:
    """High unsupervised score while the supervised score stays under its
    threshold -- candidates no labelled pattern explains.  ``sup_max`` is a number
    or the one-row result of ``metrics.f2_threshold`` on the same scores."""
    rows = scored.where(F.col("fraud_score_iso") >= F.lit(iso_min))
    if isinstance(sup_max, DataFrame):
        # one row by construction: broadcasting it is bounded
        rows = rows.crossJoin(F.broadcast(sup_max.select(F.col("best_threshold").alias("_max"))))
    else:
        rows = rows.withColumn("_max", F.lit(float(sup_max)))
    return (rows.where(F.col("fraud_score_xgb") < F.col("_max"))
            .select("npi", "specialty", "state", "fraud_score_xgb", "fraud_score_iso", "fraud_score_ensemble",
                    "fraud_tier", "flag_count", "is_fraud_label")
            .orderBy(F.col("fraud_score_iso").desc(), "npi"))


def teaser_counts(scored: DataFrame) -> DataFrame:
    """Providers analysed and providers in CRITICAL."""
    return scored.agg(F.count(F.lit(1)).alias("total_providers"),
                      F.count_if(F.col("fraud_tier") == "CRITICAL").alias("n_critical"))


def lookup(scored: DataFrame, npi: str) -> DataFrame:
    """C13 + C19: one provider by trimmed NPI (filter pushed to the scan);
    missing scores/flags default to 0 and a missing tier to UNKNOWN."""
    row = scored.where(F.col("npi") == F.lit(npi.strip()))
    defaults = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in
                ["fraud_score_ensemble", "fraud_score_xgb", "fraud_score_iso"] if c in scored.columns}
    defaults.update({c: F.coalesce(F.col(c), F.lit(0)) for c in [*FLAG_COLUMNS, "flag_count"] if c in scored.columns})
    if "fraud_tier" in scored.columns:
        defaults["fraud_tier"] = F.coalesce(F.col("fraud_tier"), F.lit("UNKNOWN"))
    return row.withColumns(defaults)


def _bar_class(v: Column) -> Column:
    expr = None
    for name, cut in SCORE_BAR_CUTS:
        cond = v > F.lit(cut)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit("green"))


def score_cards(scored: DataFrame) -> DataFrame:
    """The three scores per provider in long form with their colour class
    (strict '>' cut-offs, unlike the tiers)."""
    items = F.array(*[F.struct(F.lit(lbl).alias("score_name"), F.coalesce(F.col(c), F.lit(0.0)).alias("value"))
                      for lbl, c in [("supervised", "fraud_score_xgb"), ("unsupervised", "fraud_score_iso"),
                                     ("ensemble", "fraud_score_ensemble")]])
    return (scored.select("npi", F.inline(items))
            .select("npi", "score_name", "value", _bar_class(F.col("value")).alias("bar_class")))


def triggered_flags(scored: DataFrame) -> DataFrame:
    """Per provider, the labels of triggered flags ('; '-joined) and the count."""
    return scored.select("npi", F.coalesce(F.col("flag_count"), F.lit(0)).alias("flag_count"),
                         _triggered().alias("triggered"))


def _triggered() -> F.Column:
    labels = F.array(*[F.when(F.col(c) == 1, F.lit(lbl)) for c, lbl in FLAG_LABELS])
    return F.concat_ws("; ", F.filter(labels, lambda x: x.isNotNull()))


def provider_report(scored: DataFrame, alerts: DataFrame, exclusions: DataFrame) -> DataFrame:
    """M18 (batch form): the lookup page for every provider -- identity, the three scores,
    tier, flags, billing metrics with the specialty means of A20 (NULL in a specialty of
    at most 10 providers), top reasons and exclusion-list status."""
    ex = exclusions.select("npi").distinct().withColumn("_on_list", F.lit(1))
    r = alerts.select("npi", "reason_1", "reason_2", "reason_3")
    means = _peer_means(scored, 10)
    j = (scored.withColumn("triggered", _triggered()).join(bounded_broadcast(means), "specialty", "left")
         .join(r, "npi", "left").join(ex, "npi", "left"))
    return j.select(
        "npi", F.concat(F.lit("Dr. "), F.concat_ws(" ", "first_name", "last_name")).alias("display_name"),
        "specialty", "state",
        F.coalesce("fraud_score_ensemble", F.lit(0.0)).alias("fraud_score_ensemble"),
        F.coalesce("fraud_score_xgb", F.lit(0.0)).alias("fraud_score_xgb"),
        F.coalesce("fraud_score_iso", F.lit(0.0)).alias("fraud_score_iso"),
        *[round_half_even(F.col(f"_avg_{m}") * F.lit(s), 4).alias(f"peer_avg_{m}") for m, s in PEER_METRICS],
        F.coalesce("fraud_tier", F.lit("UNKNOWN")).alias("fraud_tier"),
        F.coalesce("flag_count", F.lit(0)).alias("flag_count"), "triggered",
        "total_claim_count", "total_drug_cost", "cost_per_claim", "brand_share", "opioid_share",
        "reason_1", "reason_2", "reason_3",
        F.coalesce("is_fraud_label", F.lit(0)).alias("label_confirmed"),
        F.coalesce("_on_list", F.lit(0)).alias("on_exclusion_list"))


def cost_scatter(scored: DataFrame, tiers: Sequence[str] = ("CRITICAL", "HIGH"), k: int = 500) -> DataFrame:
    """(cost in $K, score, tier, specialty) for the first ``k`` providers of
    the tiers, in NPI order (made deterministic)."""
    return (scored.where(F.col("fraud_tier").isin(*tiers)).orderBy("npi").limit(k)
            .select("npi", (F.col("total_drug_cost") / F.lit(1000.0)).alias("cost_k"), "fraud_score_ensemble",
                    "fraud_tier", "specialty"))


def sample_fixed(df: DataFrame, n: int, key: str = "npi") -> DataFrame:
    """A reproducible sample of exactly ``min(n, rows)`` rows -- the ``n``
    smallest md5-derived hashes of the key (top-k, no full sort)."""
    return df.withColumn("_h", stable_hash(F.col(key))).orderBy("_h", key).limit(n).drop("_h")


def opioid_scatter(scored: DataFrame, n: int = 2000) -> DataFrame:
    """(opioid %, score, tier) for a fixed-size reproducible sample."""
    s = sample_fixed(scored, n)
    return s.select("npi", round_half_even(F.col("opioid_share") * F.lit(100.0), 4).alias("opioid_pct"),
                    "fraud_score_ensemble", F.coalesce("fraud_tier", F.lit("LOW")).alias("fraud_tier"), "specialty")


def state_bubbles(scored: DataFrame) -> DataFrame:
    """Per state -- providers, high-risk %, marker size max(critical, 2) x 0.8
    and mean score."""
    return _state_rows(scored).select("state", "total_providers", "high_risk_pct",
                    (F.greatest(F.col("critical_count"), F.lit(2)) * F.lit(0.8)).alias("marker_size"),
                    "avg_fraud_score")
