"""Oracle SQL (DuckDB dialect) for every registered query.

Written independently of the Spark operators, the straightforward way:
COUNT(DISTINCT), window functions, ``quantile_cont``.  The driver runs these
against the same parquet tables and compares results with the Spark output.

Spelling differences from Spark: ``round_even(x, 0)`` for ``rint``,
``quantile_cont`` for exact percentiles, ``2.0::DOUBLE`` to force double
division.
"""

from __future__ import annotations

BENCH_METRICS = ["total_claim_count", "total_drug_cost", "cost_per_claim", "brand_share",
                 "opioid_share", "claims_per_bene", "cost_per_beneficiary"]
Z_METRICS = BENCH_METRICS[:6]
PCT_METRICS = BENCH_METRICS[:4]


def rnd(expr: str, digits: int) -> str:
    if digits == 0:
        return f"round_even({expr}, 0)"
    scale = f"{10 ** digits}.0"
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"


def emean(expr: str, scale: int, over: str = "", filt: str = "") -> str:
    """Exact mean of values on a ``scale``-decimal grid: decimal sum / count."""
    f = f" FILTER (WHERE {filt})" if filt else ""
    return f"(CAST(sum(CAST({expr} AS DECIMAL(18,{scale}))){f}{over} AS DOUBLE) / count({expr}){f}{over})"


def title(expr: str) -> str:
    toks = rf"regexp_extract_all(lower(regexp_replace({expr}, '^\s+|\s+$', '', 'g')), '(\p{{L}}+|[^\p{{L}}]+)', 1)"
    return (f"CASE WHEN {expr} IS NULL THEN NULL ELSE array_to_string("
            f"list_transform({toks}, lambda t: upper(substr(t, 1, 1)) || substr(t, 2)), '') END")


def ratio(num: str, den: str, digits: int) -> str:
    return rnd(f"CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0)", digits)


def _rollup(by_year: bool) -> str:
    year_sel = ", CAST(year(l.l_shipdate) AS INTEGER) AS data_year" if by_year else ""
    year_grp = ", year(l.l_shipdate)" if by_year else ""
    return f"""
    SELECT '1' || lpad(CAST(c.c_custkey AS VARCHAR), 9, '0') AS npi,
           split_part(c.c_name, '#', 2) AS nppes_provider_last_org_name,
           split_part(c.c_name, '#', 1) AS nppes_provider_first_name,
           n.n_name AS nppes_provider_state,
           c.c_mktsegment AS specialty_description,
           count(*) AS total_claim_count,
           CAST(count(*) FILTER (WHERE l.l_linestatus = 'F') AS BIGINT) AS total_30_day_fill_count,
           CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_drug_cost,
           count(DISTINCT l.l_orderkey) AS total_beneficiaries,
           CAST(count(*) FILTER (WHERE p.p_type IN ('LARGE','MEDIUM','STANDARD','ECONOMY')) AS BIGINT) AS brand_claim_count,
           CAST(count(*) - count(*) FILTER (WHERE p.p_type IN ('LARGE','MEDIUM','STANDARD','ECONOMY')) AS BIGINT)
               AS generic_claim_count,
           CAST(count(*) FILTER (WHERE p.p_type = 'SMALL') AS BIGINT) AS opioid_claim_count,
           count(DISTINCT CASE WHEN p.p_type = 'SMALL' THEN l.l_orderkey END) AS opioid_bene_count,
           CAST(CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END AS INTEGER) AS is_fraud_label
           {year_sel}
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN part p ON l.l_partkey = p.p_partkey
    GROUP BY c.c_custkey, c.c_name, n.n_name, c.c_mktsegment, c.c_acctbal {year_grp}"""


def _provider_cols() -> str:
    return f"""npi, nppes_provider_last_org_name AS last_name, nppes_provider_first_name AS first_name,
           nppes_provider_state AS state, {title('specialty_description')} AS specialty,
           total_claim_count, total_30_day_fill_count, total_drug_cost, total_beneficiaries,
           brand_claim_count, generic_claim_count, opioid_claim_count, opioid_bene_count, is_fraud_label,
           {ratio('total_drug_cost', 'total_claim_count', 2)} AS cost_per_claim,
           {ratio('total_drug_cost', 'total_beneficiaries', 2)} AS cost_per_beneficiary,
           {ratio('brand_claim_count', 'total_claim_count', 4)} AS brand_share,
           {ratio('opioid_claim_count', 'total_claim_count', 4)} AS opioid_share,
           {ratio('total_claim_count', 'total_beneficiaries', 2)} AS claims_per_bene"""


def _bench_cols() -> str:
    parts = []
    for m in BENCH_METRICS:
        parts += [f"avg({m}) AS avg_{m}", f"stddev_samp({m}) AS std_{m}",
                  f"quantile_cont({m}, 0.5) AS p50_{m}", f"quantile_cont({m}, 0.95) AS p95_{m}",
                  f"quantile_cont({m}, 0.99) AS p99_{m}"]
    return ",\n           ".join(parts)


def _feature_cols() -> str:
    parts = []
    for m in Z_METRICS:
        parts.append(f"{rnd(f'(p.{m} - b.avg_{m}) / nullif(b.std_{m}, 0)', 3)} AS z_{m}")
    for m in PCT_METRICS:
        pr = (f"(rank() OVER (PARTITION BY p.specialty ORDER BY p.{m}) "
              f"+ (count(*) OVER (PARTITION BY p.specialty, p.{m}) - 1) / 2.0::DOUBLE) "
              f"/ count(p.{m}) OVER (PARTITION BY p.specialty)")
        parts.append(f"CASE WHEN p.{m} IS NULL OR p.specialty IS NULL THEN NULL ELSE {rnd(pr, 4)} END AS pct_{m}")
    parts += [
        "CAST(CASE WHEN p.total_claim_count > b.p99_total_claim_count THEN 1 ELSE 0 END AS INTEGER) AS flag_high_volume",
        "CAST(CASE WHEN p.cost_per_claim > b.p99_cost_per_claim THEN 1 ELSE 0 END AS INTEGER) AS flag_high_cost_per_claim",
        "CAST(CASE WHEN p.brand_share > 0.70 THEN 1 ELSE 0 END AS INTEGER) AS flag_brand_heavy",
        "CAST(CASE WHEN p.claims_per_bene > b.p95_claims_per_bene THEN 1 ELSE 0 END AS INTEGER) AS flag_concentrated_benes",
        "CAST(CASE WHEN p.opioid_share > 0.20 THEN 1 ELSE 0 END AS INTEGER) AS flag_opioid_heavy",
    ]
    return ",\n           ".join(parts)


def _pct_global(m: str) -> str:
    return (f"(rank() OVER (ORDER BY {m}) + (count(*) OVER (PARTITION BY {m}) - 1) / 2.0::DOUBLE) "
            f"/ count({m}) OVER ()")


Z_REASON_FEATURES = ["z_total_claim_count", "z_total_drug_cost", "z_cost_per_claim",
                     "z_brand_share", "z_opioid_share", "z_claims_per_bene"]


def _reasons_cte() -> str:
    unnest_rows = ", ".join(
        f"({i}, '{f}', coalesce(f.{f}, 0.0))" for i, f in enumerate(Z_REASON_FEATURES))
    return f"""
top_scores AS (
    SELECT npi FROM providers ORDER BY fraud_score_ensemble DESC NULLS LAST, npi LIMIT 500
),
reason_items AS (
    SELECT f.npi, v.pos, v.feature, v.val
    FROM feat f JOIN top_scores t ON f.npi = t.npi,
    LATERAL (VALUES {unnest_rows}) AS v(pos, feature, val)
),
reason_ranked AS (
    SELECT npi, feature, val,
           row_number() OVER (PARTITION BY npi ORDER BY abs(val) DESC, pos) AS rn
    FROM reason_items
),
fraud_alerts AS (
    SELECT npi,
      max(CASE WHEN rn = 1 THEN printf('%s: %.2f (impact %+.3f)', feature, {rnd('val', 2)}, {rnd('val', 3)}) END) AS reason_1,
      max(CASE WHEN rn = 2 THEN printf('%s: %.2f (impact %+.3f)', feature, {rnd('val', 2)}, {rnd('val', 3)}) END) AS reason_2,
      max(CASE WHEN rn = 3 THEN printf('%s: %.2f (impact %+.3f)', feature, {rnd('val', 2)}, {rnd('val', 3)}) END) AS reason_3
    FROM reason_ranked GROUP BY npi
)"""


def views_sql() -> str:
    """The CTE chain: raw roll-up -> cleaning -> peers -> scores -> views."""
    return f"""WITH
raw AS ({_rollup(False)}),
clean0 AS (
    SELECT * FROM raw
    WHERE total_claim_count >= 11 AND total_beneficiaries >= 11
      AND regexp_full_match(regexp_replace(npi, '^\\s+|\\s+$', '', 'g'), '[12][0-9]{{9}}')
),
outl AS (
    SELECT specialty_description AS sd, quantile_cont(total_drug_cost, 0.999) AS q
    FROM clean0 WHERE specialty_description IS NOT NULL GROUP BY specialty_description
),
clean1 AS (
    SELECT c.* FROM clean0 c LEFT JOIN outl o ON c.specialty_description = o.sd
    WHERE o.q IS NULL OR NOT (c.total_drug_cost > o.q * 20.0)
),
providers0 AS (SELECT {_provider_cols()}, 2022 AS data_year FROM clean1),
bench AS (
    SELECT specialty, count(*) AS n_providers,
           {_bench_cols()}
    FROM providers0 WHERE specialty IS NOT NULL GROUP BY specialty
),
feat AS (
    SELECT p.*,
           {_feature_cols()}
    FROM providers0 p LEFT JOIN bench b ON p.specialty = b.specialty
),
feat2 AS (
    SELECT *, flag_high_volume + flag_high_cost_per_claim + flag_brand_heavy + flag_concentrated_benes
              + flag_opioid_heavy AS flag_count
    FROM feat
),
sc AS (
    SELECT npi, {_pct_global('total_claim_count')} AS fraud_score_xgb,
           {_pct_global('total_drug_cost')} AS fraud_score_iso
    FROM providers0
),
scores AS (
    SELECT npi, fraud_score_xgb, fraud_score_iso,
           0.6 * fraud_score_xgb + 0.4 * fraud_score_iso AS fraud_score_ensemble,
           CASE WHEN 0.6 * fraud_score_xgb + 0.4 * fraud_score_iso >= 0.8 THEN 'CRITICAL'
                WHEN 0.6 * fraud_score_xgb + 0.4 * fraud_score_iso >= 0.6 THEN 'HIGH'
                WHEN 0.6 * fraud_score_xgb + 0.4 * fraud_score_iso >= 0.4 THEN 'MODERATE'
                ELSE 'LOW' END AS fraud_tier
    FROM sc
),
provider_features AS (
    SELECT npi, specialty, {', '.join('z_' + m for m in Z_METRICS)}, {', '.join('pct_' + m for m in PCT_METRICS)},
           flag_high_volume, flag_high_cost_per_claim, flag_brand_heavy, flag_concentrated_benes,
           flag_opioid_heavy, flag_count
    FROM feat2
),
providers AS (
    SELECT p.*, f.flag_count, f.flag_high_volume, f.flag_high_cost_per_claim, f.flag_brand_heavy,
           f.flag_concentrated_benes, f.flag_opioid_heavy, f.z_total_claim_count, f.z_cost_per_claim,
           f.z_brand_share, f.z_opioid_share,
           s.fraud_score_xgb, s.fraud_score_iso, s.fraud_score_ensemble, s.fraud_tier
    FROM providers0 p LEFT JOIN feat2 f ON p.npi = f.npi LEFT JOIN scores s ON p.npi = s.npi
),
years_raw AS ({_rollup(True)}),
provider_years AS (SELECT {_provider_cols()}, data_year FROM years_raw),
oig_exclusions AS (
    SELECT DISTINCT '1' || lpad(CAST(c.c_custkey AS VARCHAR), 9, '0') AS npi,
           CAST(o.o_orderdate AS DATE) AS exclusion_date
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    WHERE c.c_acctbal < 0 AND o.o_orderpriority = '1-URGENT'
),{_reasons_cte()}
"""


def q(body: str) -> str:
    return views_sql() + body
