"""Registered report, table and metric queries with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.functions import round_half_even
from peerscope.operators import metrics as M
from peerscope.operators import peers as P
from peerscope.operators import reports as R
from peerscope.operators import scoring as S
from peerscope.plans import oracle as O
from peerscope.plans.views import workspace

PCT = "100.0::DOUBLE"
MONEY = "CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"
TIERS_SQL = "(VALUES ('CRITICAL', 1), ('HIGH', 2), ('MODERATE', 3), ('LOW', 4)) AS t(fraud_tier, tier_order)"
HASH_SQL = "CAST(('0x' || substr(md5({k}), 1, 8)) AS BIGINT)"
ISO_MIN = 0.05            # fixture; 0.80 in the operator
EVAL_SCORE = "fraud_score_xgb"


def _round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[round_half_even(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _eval_frame(ws) -> DataFrame:
    return ws.providers_scored.select("npi", F.col(EVAL_SCORE).alias("score"),
                                      F.col("is_fraud_label").alias("label"))


def _class_report(ws) -> DataFrame:
    ev = _eval_frame(ws)
    thr = M.f2_threshold(ev)
    return M.classification_report(ev, thr)


def _fold_metrics(ws) -> DataFrame:
    folds = M.stratified_folds(ws.providers_scored.select("npi", "is_fraud_label"))
    ev = _eval_frame(ws).join(folds.select("npi", "fold"), "npi", "inner")
    return M.curve_metrics(ev, keys=["fold"])


def _on_list(ws) -> DataFrame:
    ex = ws.exclusions.select("npi").distinct().withColumn("_x", F.lit(1))
    return (ws.providers_scored.select("npi", "is_fraud_label").join(ex, "npi", "left")
            .select("npi", "is_fraud_label", F.coalesce("_x", F.lit(0)).alias("on_exclusion_list")))


def _dup_keys(ws) -> DataFrame:
    return (ws.providers.groupBy("npi").agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def _orphans(ws) -> DataFrame:
    return ws.provider_features.select("npi").join(ws.providers.select("npi"), "npi", "left_anti")


def report_queries() -> dict:
    w = workspace
    return {
        "s7_providers": lambda s, d: w(s, d).providers,
        "s8_provider_features": lambda s, d: w(s, d).provider_features,
        "a1_specialty_benchmarks": lambda s, d: _round_doubles(w(s, d).benchmarks),
        "m1_model_matrix": lambda s, d: P.model_matrix(w(s, d).features, fill_nulls=True),
        "m7_ensemble_scores": lambda s, d: w(s, d).scores,
        "j12_exclusion_flag": lambda s, d: _on_list(w(s, d)),
        "s10_duplicate_keys": lambda s, d: _dup_keys(w(s, d)),
        "s10_orphan_features": lambda s, d: _orphans(w(s, d)),
        "a2_clean_summary": lambda s, d: R.clean_summary(w(s, d).providers),
        "a3_top_specialties_by_count": lambda s, d: R.top_specialties_by_count(w(s, d).providers),
        "a4_flag_distribution": lambda s, d: R.flag_distribution(w(s, d).features),
        "a5_flag_separation": lambda s, d: R.flag_separation(w(s, d).features),
        "a6_validation_counts": lambda s, d: R.validation_counts(w(s, d).providers, w(s, d).provider_features),
        "a7_top_specialties_by_cost": lambda s, d: R.top_specialties_by_cost(w(s, d).providers),
        "a8_class_distribution": lambda s, d: R.class_distribution(w(s, d).providers),
        "a9_tier_distribution": lambda s, d: R.tier_distribution(w(s, d).providers_scored),
        "a10_critical_confirmation": lambda s, d: S.critical_confirmation(w(s, d).providers_scored),
        "a17_overview_headline": lambda s, d: R.overview_headline(w(s, d).providers_scored),
        "a18_score_histogram": lambda s, d: R.score_histogram(w(s, d).providers_scored),
        "a19_top_flagged_specialties": lambda s, d: R.top_flagged_specialties(w(s, d).providers_scored),
        "a20_peer_comparison": lambda s, d: R.peer_comparison(w(s, d).providers_scored),
        "a21_high_risk_cards": lambda s, d: R.high_risk_cards(w(s, d).providers_scored),
        "a22_flagged_by_state": lambda s, d: R.flagged_by_state(w(s, d).providers_scored),
        "a23_state_table": lambda s, d: R.state_table(w(s, d).providers_scored),
        "a24_brand_share_box": lambda s, d: R.brand_share_box(w(s, d).providers_scored),
        "a25_brand_share_by_tier": lambda s, d: R.brand_share_by_tier(w(s, d).providers_scored),
        "a26_opioid_by_specialty": lambda s, d: R.opioid_by_specialty(w(s, d).providers_scored),
        "a27_cost_per_claim_by_tier": lambda s, d: R.cost_per_claim_by_tier(w(s, d).providers_scored),
        "a28_pattern_table": lambda s, d: R.pattern_table(w(s, d).providers_scored),
        "a29_distinct_states": lambda s, d: R.distinct_values(w(s, d).providers_scored, "state"),
        "a29_distinct_specialties": lambda s, d: R.distinct_values(w(s, d).providers_scored, "specialty"),
        "a30_isolation_only": lambda s, d: R.isolation_only(w(s, d).providers_scored, M.f2_threshold(_eval_frame(w(s, d))),
                                                            ISO_MIN),
        "a31_teaser_counts": lambda s, d: R.teaser_counts(w(s, d).providers_scored),
        "c18_high_risk_table": lambda s, d: R.high_risk_table(w(s, d).providers_scored),
        "m16_score_cards": lambda s, d: R.score_cards(w(s, d).providers_scored),
        "m17_triggered_flags": lambda s, d: R.triggered_flags(w(s, d).providers_scored),
        "m18_provider_report": lambda s, d: R.provider_report(w(s, d).providers_scored, w(s, d).alerts,
                                                              w(s, d).exclusions),
        "m19_cost_scatter": lambda s, d: R.cost_scatter(w(s, d).providers_scored),
        "m19_opioid_scatter": lambda s, d: R.opioid_scatter(w(s, d).providers_scored),
        "m19_state_bubbles": lambda s, d: R.state_bubbles(w(s, d).providers_scored),
        "m9_top_reasons": lambda s, d: w(s, d).reasons,
        "m2_stratified_folds": lambda s, d: M.stratified_folds(w(s, d).providers_scored.select("npi", "is_fraud_label")),
        "m10_curve_metrics": lambda s, d: M.curve_metrics(_eval_frame(w(s, d))),
        "m12_pr_curve": lambda s, d: M.pr_curve(_eval_frame(w(s, d))),
        "m13_f2_threshold": lambda s, d: M.f2_threshold(_eval_frame(w(s, d))),
        "m14_classification_report": lambda s, d: _class_report(w(s, d)),
        "m15_fold_metrics": lambda s, d: _fold_metrics(w(s, d)),
    }


def _r(e, d):
    return O.rnd(e, d)


def _bench_sql() -> str:
    cols = ["specialty", "n_providers"]
    for m in O.BENCH_METRICS:
        for s in ("avg", "std", "p50", "p95", "p99"):
            cols.append(f"{_r(f'{s}_{m}', 6)} AS {s}_{m}")
    return f"SELECT {', '.join(cols)} FROM bench"


def _matrix_sql() -> str:
    feats = []
    for c in P.FEATURE_COLUMNS:
        feats.append(f"coalesce({c}, 0) AS {c}")
    return f"SELECT npi, specialty AS specialty_description, {', '.join(feats)}, is_fraud_label FROM feat2"


CURVE_SQL = f"""
, s AS (SELECT fraud_score_xgb AS score, is_fraud_label AS label FROM providers WHERE {EVAL_SCORE} IS NOT NULL),
pts AS (SELECT score, count(*) AS n, sum(label) AS pos FROM s GROUP BY score),
cum AS (
  SELECT score, n, pos,
         sum(pos) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS seen,
         sum(pos) OVER () AS n_pos, sum(n) OVER () AS n_all
  FROM pts),
curve AS (
  SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(seen - tp AS BIGINT) AS fp, pos, n - pos AS neg_at,
         n_all - seen - (n_pos - tp) AS neg_below, n_pos, n_all - n_pos AS n_neg,
         tp / CAST(seen AS DOUBLE) AS precision, tp / CAST(n_pos AS DOUBLE) AS recall
  FROM cum),
prc AS (
  SELECT threshold, tp, fp, {_r('precision', 10)} AS precision, {_r('recall', 10)} AS recall,
         {_r('5.0 * precision * recall / (4.0 * precision + recall + 1e-10)', 10)} AS f2
  FROM curve),
raw_f2 AS (SELECT threshold, 5.0::DOUBLE * precision * recall / (4.0::DOUBLE * precision + recall + 1e-10::DOUBLE) AS v FROM curve),
best AS (SELECT threshold AS best_threshold, {_r('v', 10)} AS best_f2 FROM raw_f2 ORDER BY v DESC, threshold ASC LIMIT 1)
"""


def _curve_metrics_sql(part: str = "") -> str:
    keys = f"{part}, " if part else ""
    grp = f"GROUP BY {part}" if part else ""
    return f"""
SELECT {keys}CAST(max(n_pos) AS BIGINT) AS n_pos, CAST(max(n_neg) AS BIGINT) AS n_neg,
       {_r('sum(pos * precision) / CAST(NULLIF(max(n_pos), 0) AS DOUBLE)', 10)} AS pr_auc,
       {_r('sum(pos * (neg_below + neg_at / 2.0::DOUBLE)) / CAST(NULLIF(max(n_pos) * max(n_neg), 0) AS DOUBLE)', 10)} AS roc_auc,
       {_r('max(n_pos) / CAST(max(n_pos) + max(n_neg) AS DOUBLE)', 10)} AS baseline
FROM curve {grp}"""


FOLDS_SQL = f"""
, folds AS (
  SELECT npi, is_fraud_label,
         CAST((row_number() OVER (PARTITION BY is_fraud_label ORDER BY {HASH_SQL.format(k='npi')}, npi) - 1) % 5 + 1
              AS INTEGER) AS fold
  FROM providers)
"""


def _class_report_sql() -> str:
    def prf(tp, fp, fn):
        p = f"coalesce({tp} / nullif(CAST({tp} + {fp} AS DOUBLE), 0), 0.0)"
        r = f"coalesce({tp} / nullif(CAST({tp} + {fn} AS DOUBLE), 0), 0.0)"
        f = f"coalesce(2.0 * ({p}) * ({r}) / nullif(({p}) + ({r}), 0), 0.0)"
        return p, r, f
    p0, r0, f0 = prf("tn", "fn", "fp")
    p1, r1, f1 = prf("tp", "fp", "fn")
    return CURVE_SQL + f"""
, cm AS (
  SELECT count(*) FILTER (WHERE s.score >= b.best_threshold AND s.label = 1) AS tp,
         count(*) FILTER (WHERE s.score >= b.best_threshold AND s.label = 0) AS fp,
         count(*) FILTER (WHERE s.score < b.best_threshold AND s.label = 0) AS tn,
         count(*) FILTER (WHERE s.score < b.best_threshold AND s.label = 1) AS fn
  FROM s CROSS JOIN best b),
v AS (
  SELECT {p0} AS p0, {r0} AS r0, {f0} AS f0, {p1} AS p1, {r1} AS r1, {f1} AS f1,
         tn + fp AS s0, tp + fn AS s1, tp, tn FROM cm)
SELECT pos, class, {_r('precision', 10)} AS precision, {_r('recall', 10)} AS recall, {_r('f1', 10)} AS f1,
       CAST(support AS BIGINT) AS support FROM (
  SELECT 1 AS pos, 'Normal' AS class, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM v
  UNION ALL SELECT 2, 'Fraud', p1, r1, f1, s1 FROM v
  UNION ALL SELECT 3, 'accuracy', NULL, NULL, (tp + tn) / CAST(s0 + s1 AS DOUBLE), s0 + s1 FROM v
  UNION ALL SELECT 4, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM v
  UNION ALL SELECT 5, 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
                   (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 FROM v) x
ORDER BY pos"""


def _pattern_sql() -> str:
    aggs = ["count(*) FILTER (WHERE fraud_tier = 'LOW') AS nn", "count(*) FILTER (WHERE fraud_tier = 'CRITICAL') AS nf"]
    rows = []
    for i, (label, c, scale, floor) in enumerate(R.PATTERN_METRICS):
        d = R.PATTERN_SCALES[c]
        aggs += [f"{O.emean(c, d, filt="fraud_tier = 'LOW'")} AS n_{c}",
                 f"{O.emean(c, d, filt="fraud_tier = 'CRITICAL'")} AS f_{c}"]
        den = f"n_{c}" if floor is None else f"greatest(n_{c}, {floor}::DOUBLE)"
        rows.append(f"SELECT {i + 1} AS pos, '{label}' AS metric, {_r(f'n_{c} * {scale}::DOUBLE', 4)} AS normal, "
                    f"{_r(f'f_{c} * {scale}::DOUBLE', 4)} AS fraud, {_r(f'f_{c} / {den}', 4)} AS ratio "
                    f"FROM g WHERE nn > 0 AND nf > 0")
    return f", g AS (SELECT {', '.join(aggs)} FROM providers)\n" + "\nUNION ALL ".join(rows) + "\nORDER BY pos"


def _peer_means_cte() -> str:
    cols = ", ".join(f"{_r(f'{O.emean(m, d)} * {scale}::DOUBLE', 4)} AS peer_avg_{m}"
                     for (m, scale), (_, d) in zip(R.PEER_METRICS, R.PEER_SCALES))
    return (f", pm AS (SELECT specialty, {cols} FROM providers WHERE specialty IS NOT NULL "
            f"GROUP BY specialty HAVING count(*) > 10)\n")


def _peer_sql() -> str:
    parts = []
    for m, scale in R.PEER_METRICS:
        parts.append(f"SELECT npi, specialty, '{m}' AS metric, {_r(f'{m} * {scale}::DOUBLE', 4)} AS provider_value, "
                     f"{_r(f'avg_{m} * {scale}::DOUBLE', 4)} AS peer_avg FROM pw WHERE n_peers > 10")
    avgs = ", ".join(f"{O.emean(m, d, ' OVER (PARTITION BY specialty)')} AS avg_{m}" for m, d in R.PEER_SCALES)
    return (f", pw AS (SELECT *, count(*) OVER (PARTITION BY specialty) AS n_peers, {avgs} "
            f"FROM providers WHERE specialty IS NOT NULL)\n" + "\nUNION ALL ".join(parts))


def _state_table_sql(extra: str = "") -> str:
    return f"""
, st AS (
  SELECT state, count(*) AS total_providers,
         count(*) FILTER (WHERE fraud_tier = 'CRITICAL') AS critical_count,
         count(*) FILTER (WHERE fraud_tier = 'HIGH') AS high_count,
         {_r('avg(fraud_score_ensemble)', 4)} AS avg_fraud_score,
         {_r(MONEY.format(c='total_drug_cost') + ' / 1e6', 1)} AS total_drug_cost_m,
         CAST(sum(is_fraud_label) AS BIGINT) AS oig_confirmed,
         {_r(f"{PCT} * (count(*) FILTER (WHERE fraud_tier = 'CRITICAL') + count(*) FILTER (WHERE fraud_tier = 'HIGH')) / count(*)", 2)}
             AS high_risk_pct,
         count(*) FILTER (WHERE fraud_tier = 'CRITICAL') + count(*) FILTER (WHERE fraud_tier = 'HIGH') AS high_risk_total
  FROM providers WHERE state IS NOT NULL GROUP BY state)
{extra}"""


def _high_risk_top(k: int = 100) -> str:
    return (f", hr AS (SELECT * FROM providers WHERE fraud_tier IN ('CRITICAL', 'HIGH') "
            f"ORDER BY fraud_score_ensemble DESC, npi LIMIT {k})\n")


def report_sql() -> dict:
    r = _r
    q = O.q
    return {
        "s7_providers": q("SELECT * FROM providers0"),
        "s8_provider_features": q("SELECT * FROM provider_features"),
        "a1_specialty_benchmarks": q(_bench_sql()),
        "m1_model_matrix": q(_matrix_sql()),
        "m7_ensemble_scores": q("SELECT * FROM scores"),
        "j12_exclusion_flag": q("""
SELECT p.npi, p.is_fraud_label,
       CASE WHEN EXISTS (SELECT 1 FROM oig_exclusions o WHERE o.npi = p.npi) THEN 1 ELSE 0 END AS on_exclusion_list
FROM providers p"""),
        "s10_duplicate_keys": q("SELECT npi, count(*) AS n_rows FROM providers0 GROUP BY npi HAVING count(*) > 1"),
        "s10_orphan_features": q("SELECT f.npi FROM provider_features f WHERE f.npi NOT IN (SELECT npi FROM providers0)"),
        "a2_clean_summary": q(f"""
SELECT count(*) AS total_providers, {r(MONEY.format(c='total_drug_cost') + ' / 1e9', 2)} AS total_cost_b,
       {r('avg(total_claim_count)', 0)} AS avg_claims, {r(O.emean('cost_per_claim', 2), 0)} AS avg_cost_per_claim,
       {r(O.emean('brand_share', 4) + ' * 100.0::DOUBLE', 1)} AS avg_brand_pct, CAST(sum(is_fraud_label) AS BIGINT) AS fraud_labels,
       {r(f'{PCT} * sum(is_fraud_label) / count(*)', 2)} AS fraud_pct
FROM providers0"""),
        "a3_top_specialties_by_count": q("""
SELECT specialty, count(*) AS n_providers FROM providers0 WHERE specialty IS NOT NULL
GROUP BY specialty ORDER BY n_providers DESC, specialty LIMIT 5"""),
        "a4_flag_distribution": q(f"""
, lv AS (SELECT CAST(range AS INTEGER) AS flag_count FROM range(6)),
c AS (SELECT flag_count, count(*) AS n FROM feat2 GROUP BY flag_count)
SELECT lv.flag_count, CAST(coalesce(c.n, 0) AS BIGINT) AS n_providers,
       {r(f'{PCT} * coalesce(c.n, 0) / (SELECT count(*) FROM feat2)', 1)} AS pct
FROM lv LEFT JOIN c ON lv.flag_count = c.flag_count ORDER BY lv.flag_count"""),
        "a5_flag_separation": q(f"""
, g AS (SELECT avg(CASE WHEN is_fraud_label = 1 THEN flag_count END) AS f,
               avg(CASE WHEN is_fraud_label = 0 THEN flag_count END) AS n FROM feat2)
SELECT {r('f', 2)} AS avg_flags_fraud, {r('n', 2)} AS avg_flags_normal, {r('f / nullif(n, 0)', 1)} AS flag_separation
FROM g"""),
        "a6_validation_counts": q("""
SELECT (SELECT count(*) FROM providers0) AS total_providers,
       (SELECT count(*) FROM providers0 WHERE is_fraud_label = 1) AS fraud_labels,
       (SELECT count(DISTINCT specialty) FROM providers0) AS specialties,
       (SELECT count(DISTINCT state) FROM providers0) AS states,
       (SELECT count(*) FROM provider_features) AS feature_rows,
       (SELECT count(*) FROM provider_features WHERE flag_count >= 3) AS providers_3plus_flags"""),
        "a7_top_specialties_by_cost": q(f"""
SELECT specialty, count(*) AS n, {r(MONEY.format(c='total_drug_cost') + ' / 1e6', 1)} AS cost_M
FROM providers0 GROUP BY specialty ORDER BY cost_M DESC, specialty LIMIT 5"""),
        "a8_class_distribution": q(f"""
SELECT is_fraud_label AS label, count(*) AS n,
       {r(f'{PCT} * count(*) / (SELECT count(*) FROM providers0)', 1)} AS pct,
       {r('(SELECT count(*) FROM providers0 WHERE is_fraud_label = 0) / CAST(nullif((SELECT count(*) FROM providers0 WHERE is_fraud_label = 1), 0) AS DOUBLE)', 4)} AS imbalance_ratio
FROM providers0 GROUP BY is_fraud_label ORDER BY label"""),
        "a9_tier_distribution": q(f"""
, c AS (SELECT fraud_tier, count(*) AS n FROM providers GROUP BY fraud_tier)
SELECT t.fraud_tier, t.tier_order, CAST(coalesce(c.n, 0) AS BIGINT) AS n_providers,
       {r(f'{PCT} * coalesce(c.n, 0) / (SELECT count(*) FROM providers)', 1)} AS pct
FROM {TIERS_SQL} LEFT JOIN c ON t.fraud_tier = c.fraud_tier ORDER BY t.tier_order"""),
        "a10_critical_confirmation": q(f"""
, g AS (SELECT count(*) FILTER (WHERE fraud_tier = 'CRITICAL') AS n_critical,
               count(*) FILTER (WHERE fraud_tier = 'CRITICAL' AND is_fraud_label = 1) AS n_confirmed FROM providers)
SELECT n_critical, n_confirmed, coalesce({r(f'{PCT} * n_confirmed / nullif(n_critical, 0)', 1)}, 0.0) AS confirmation_pct
FROM g"""),
        "a17_overview_headline": q(f"""
SELECT count(*) AS total_providers, count(*) FILTER (WHERE fraud_tier = 'CRITICAL') AS n_critical,
       count(*) FILTER (WHERE fraud_tier = 'HIGH') AS n_high,
       {r(MONEY.format(c='total_drug_cost') + ' / 1e9', 2)} AS total_cost_b,
       {r('coalesce(' + MONEY.format(c="CASE WHEN fraud_tier IN ('CRITICAL', 'HIGH') THEN total_drug_cost END") + ', 0.0) / 1e6', 0)} AS at_risk_cost_m
FROM providers"""),
        "a18_score_histogram": q("""
, lv AS (SELECT CAST(range AS INTEGER) AS bin FROM range(50)),
c AS (SELECT CAST(least(floor(fraud_score_ensemble * 50.0), 49) AS INTEGER) AS bin, count(*) AS n
      FROM providers WHERE fraud_score_ensemble IS NOT NULL GROUP BY 1)
SELECT lv.bin, lv.bin / 50.0::DOUBLE AS bin_lo, (lv.bin + 1) / 50.0::DOUBLE AS bin_hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_providers
FROM lv LEFT JOIN c ON lv.bin = c.bin ORDER BY lv.bin"""),
        "a19_top_flagged_specialties": q("""
SELECT specialty, count(*) AS flagged_providers FROM providers
WHERE fraud_tier IN ('CRITICAL', 'HIGH') AND specialty IS NOT NULL
GROUP BY specialty ORDER BY flagged_providers DESC, specialty LIMIT 10"""),
        "a20_peer_comparison": q(_peer_sql()),
        "a21_high_risk_cards": q(_high_risk_top() + f"""
SELECT count(*) AS n_providers, {r('coalesce(' + MONEY.format(c='total_drug_cost') + ', 0.0) / 1e6', 1)} AS total_cost_m,
       {r('avg(fraud_score_ensemble)', 3)} AS avg_score, CAST(sum(is_fraud_label) AS BIGINT) AS oig_confirmed,
       {r('avg(flag_count)', 1)} AS avg_flags
FROM hr"""),
        "a22_flagged_by_state": q("""
SELECT state, count(*) AS n_flagged FROM providers
WHERE fraud_tier IN ('CRITICAL', 'HIGH') AND state IS NOT NULL
GROUP BY state ORDER BY n_flagged DESC, state LIMIT 15"""),
        "a23_state_table": q(_state_table_sql(
            "SELECT *, row_number() OVER (ORDER BY high_risk_pct DESC, state) AS rank FROM st ORDER BY rank")),
        "a24_brand_share_box": q(f"""
, b AS (SELECT fraud_tier, brand_share, brand_share * 100.0::DOUBLE AS v FROM providers WHERE brand_share IS NOT NULL)
SELECT fraud_tier, count(*) AS n, {r('quantile_cont(v, 0.0)', 4)} AS min, {r('quantile_cont(v, 0.25)', 4)} AS q1,
       {r('quantile_cont(v, 0.5)', 4)} AS median, {r('quantile_cont(v, 0.75)', 4)} AS q3,
       {r('quantile_cont(v, 1.0)', 4)} AS max, {r(O.emean('brand_share', 4) + ' * 100.0::DOUBLE', 4)} AS mean
FROM b GROUP BY fraud_tier"""),
        "a25_brand_share_by_tier": q(f"""
, g AS (SELECT fraud_tier, {O.emean('brand_share', 4)} AS m, quantile_cont(brand_share, 0.5) AS med FROM providers GROUP BY fraud_tier)
SELECT t.fraud_tier, t.tier_order, {r('g.m * 100.0::DOUBLE', 4)} AS mean_pct, {r('g.med * 100.0::DOUBLE', 4)} AS median_pct
FROM {TIERS_SQL} LEFT JOIN g ON t.fraud_tier = g.fraud_tier ORDER BY t.tier_order"""),
        "a26_opioid_by_specialty": q(f"""
SELECT specialty, {r(O.emean('opioid_share', 4) + ' * 100.0::DOUBLE', 4)} AS opioid_pct FROM providers
GROUP BY specialty ORDER BY opioid_pct DESC, specialty"""),
        "a27_cost_per_claim_by_tier": q(f"""
, g AS (SELECT fraud_tier, {O.emean('cost_per_claim', 2)} AS m, quantile_cont(cost_per_claim, 0.95) AS p FROM providers GROUP BY fraud_tier)
SELECT t.fraud_tier, t.tier_order, {r('g.m', 4)} AS avg_cost_per_claim, {r('g.p', 4)} AS p95_cost_per_claim
FROM {TIERS_SQL} LEFT JOIN g ON t.fraud_tier = g.fraud_tier ORDER BY t.tier_order"""),
        "a28_pattern_table": q(_pattern_sql()),
        "a29_distinct_states": q("SELECT DISTINCT state FROM providers WHERE state IS NOT NULL ORDER BY state"),
        "a29_distinct_specialties": q(
            "SELECT DISTINCT specialty FROM providers WHERE specialty IS NOT NULL ORDER BY specialty"),
        "a30_isolation_only": q(CURVE_SQL + f"""
SELECT npi, specialty, state, fraud_score_xgb, fraud_score_iso, fraud_score_ensemble, fraud_tier, flag_count,
       is_fraud_label
FROM providers WHERE fraud_score_iso >= {ISO_MIN} AND fraud_score_xgb < coalesce((SELECT best_threshold FROM best), 0.5)
ORDER BY fraud_score_iso DESC, npi"""),
        "a31_teaser_counts": q("""
SELECT count(*) AS total_providers, count(*) FILTER (WHERE fraud_tier = 'CRITICAL') AS n_critical FROM providers"""),
        "c18_high_risk_table": q(_high_risk_top() + f"""
SELECT npi AS NPI, first_name AS First, last_name AS Last, specialty AS Specialty, state AS State,
       fraud_tier AS Tier, printf('%.4f', {r('fraud_score_ensemble', 4)}) AS Score, total_claim_count AS Claims,
       printf('$%.0fK', {r('total_drug_cost / 1000.0', 0)}) AS Drug_Cost,
       printf('$%.0f', {r('cost_per_claim', 0)}) AS Cost_per_Claim,
       printf('%.1f%%', {r('brand_share * 100.0', 1)}) AS Brand_pct,
       printf('%.1f%%', {r('opioid_share * 100.0', 1)}) AS Opioid_pct,
       flag_count AS Flags, CASE WHEN is_fraud_label = 1 THEN 'OIG Confirmed' ELSE '' END AS OIG_Status
FROM hr"""),
        "m16_score_cards": q("""
, v AS (
  SELECT npi, 'supervised' AS score_name, coalesce(fraud_score_xgb, 0.0) AS value FROM providers
  UNION ALL SELECT npi, 'unsupervised', coalesce(fraud_score_iso, 0.0) FROM providers
  UNION ALL SELECT npi, 'ensemble', coalesce(fraud_score_ensemble, 0.0) FROM providers)
SELECT npi, score_name, value,
       CASE WHEN value > 0.8 THEN 'red' WHEN value > 0.6 THEN 'orange' WHEN value > 0.4 THEN 'yellow'
            ELSE 'green' END AS bar_class
FROM v"""),
        "m17_triggered_flags": q(_triggered_sql()),
        "m18_provider_report": q(_triggered_cte() + _peer_means_cte() + """
SELECT p.npi, 'Dr. ' || concat_ws(' ', p.first_name, p.last_name) AS display_name, p.specialty, p.state,
       coalesce(p.fraud_score_ensemble, 0.0) AS fraud_score_ensemble, coalesce(p.fraud_score_xgb, 0.0) AS fraud_score_xgb,
       coalesce(p.fraud_score_iso, 0.0) AS fraud_score_iso, pm.peer_avg_total_claim_count, pm.peer_avg_cost_per_claim,
       pm.peer_avg_brand_share, pm.peer_avg_opioid_share, coalesce(p.fraud_tier, 'UNKNOWN') AS fraud_tier,
       coalesce(p.flag_count, 0) AS flag_count, tf.triggered, p.total_claim_count, p.total_drug_cost,
       p.cost_per_claim, p.brand_share, p.opioid_share, a.reason_1, a.reason_2, a.reason_3,
       coalesce(p.is_fraud_label, 0) AS label_confirmed,
       CASE WHEN EXISTS (SELECT 1 FROM oig_exclusions o WHERE o.npi = p.npi) THEN 1 ELSE 0 END AS on_exclusion_list
FROM providers p LEFT JOIN tf ON p.npi = tf.npi LEFT JOIN fraud_alerts a ON p.npi = a.npi
LEFT JOIN pm ON p.specialty = pm.specialty"""),
        "m19_cost_scatter": q("""
SELECT npi, total_drug_cost / 1000.0 AS cost_k, fraud_score_ensemble, fraud_tier, specialty
FROM providers WHERE fraud_tier IN ('CRITICAL', 'HIGH') ORDER BY npi LIMIT 500"""),
        "m19_opioid_scatter": q(f"""
SELECT npi, {r('opioid_share * 100.0', 4)} AS opioid_pct, fraud_score_ensemble,
       coalesce(fraud_tier, 'LOW') AS fraud_tier, specialty
FROM providers ORDER BY {HASH_SQL.format(k='npi')}, npi LIMIT 2000"""),
        "m19_state_bubbles": q(_state_table_sql(
            "SELECT state, total_providers, high_risk_pct, greatest(critical_count, 2) * 0.8::DOUBLE AS marker_size, "
            "avg_fraud_score FROM st")),
        "m9_top_reasons": q("SELECT * FROM fraud_alerts"),
        "m2_stratified_folds": q(FOLDS_SQL + "SELECT npi, is_fraud_label, fold FROM folds"),
        "m10_curve_metrics": q(CURVE_SQL + _curve_metrics_sql()),
        "m12_pr_curve": q(CURVE_SQL + "SELECT * FROM prc ORDER BY threshold DESC"),
        "m13_f2_threshold": q(CURVE_SQL + """
SELECT coalesce(b.best_threshold, 0.5) AS best_threshold, coalesce(b.best_f2, 0.0) AS best_f2
FROM (SELECT 1 AS one) x LEFT JOIN best b ON TRUE"""),
        "m14_classification_report": q(_class_report_sql()),
        "m15_fold_metrics": q(FOLDS_SQL + CURVE_SQL.replace(
            f"FROM providers WHERE {EVAL_SCORE} IS NOT NULL",
            f"FROM providers p JOIN folds f USING (npi) WHERE {EVAL_SCORE} IS NOT NULL").replace(
            "SELECT fraud_score_xgb AS score, is_fraud_label AS label",
            "SELECT f.fold, fraud_score_xgb AS score, p.is_fraud_label AS label").replace(
            "pts AS (SELECT score, count(*) AS n, sum(label) AS pos FROM s GROUP BY score)",
            "pts AS (SELECT fold, score, count(*) AS n, sum(label) AS pos FROM s GROUP BY fold, score)").replace(
            "OVER (ORDER BY score DESC)", "OVER (PARTITION BY fold ORDER BY score DESC)").replace(
            "OVER ()", "OVER (PARTITION BY fold)").replace(
            "SELECT score, n, pos,", "SELECT fold, score, n, pos,").replace(
            "SELECT score AS threshold,", "SELECT fold, score AS threshold,") + _curve_metrics_sql("fold")),
    }


def _triggered_cte() -> str:
    parts = ", ".join(f"CASE WHEN {c} = 1 THEN '{lbl}' END" for c, lbl in R.FLAG_LABELS)
    return (f", tf AS (SELECT npi, coalesce(flag_count, 0) AS flag_count, concat_ws('; ', {parts}) AS triggered "
            f"FROM providers)\n")


def _triggered_sql() -> str:
    return _triggered_cte() + "SELECT npi, flag_count, triggered FROM tf"
