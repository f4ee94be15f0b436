"""The catalogue as SQL text run by ``spark.sql`` over the registered views
(entry point for analysts who write SQL).  Catalyst plans these exactly like
the DataFrame operators; rounding uses ``rint`` (half-even, as pandas)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from peerscope.plans.views import register_views, workspace


def _r(expr: str, digits: int) -> str:
    scale = f"{10 ** digits}.0D"
    return f"(rint(({expr}) * {scale}) / {scale})"


MONEY = "CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"

STATE_CONCENTRATION = f"""
SELECT state, count(*) AS total_providers,
       count_if(fraud_tier IN ('HIGH', 'CRITICAL')) AS high_risk_count,
       {_r("100.0D * count_if(fraud_tier IN ('HIGH', 'CRITICAL')) / count(*)", 2)} AS high_risk_pct,
       {_r(MONEY.format(c='total_drug_cost') + ' / 1e6D', 1)} AS total_cost_M,
       {_r('avg(fraud_score_ensemble)', 3)} AS avg_fraud_score
FROM providers WHERE fraud_tier IS NOT NULL
GROUP BY state ORDER BY high_risk_pct DESC, state"""

OIG_BY_TIER = f"""
SELECT p.fraud_tier, count(*) AS total_in_tier,
       count_if(o.npi IS NOT NULL) AS oig_confirmed,
       {_r('100.0D * count_if(o.npi IS NOT NULL) / count(*)', 2)} AS oig_match_pct
FROM providers p LEFT JOIN (SELECT DISTINCT npi FROM oig_exclusions) o ON p.npi = o.npi
GROUP BY p.fraud_tier
ORDER BY CASE p.fraud_tier WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MODERATE' THEN 3 ELSE 4 END"""

GEOGRAPHIC_CLUSTERING = f"""
SELECT state, count(*) AS total_providers,
       count_if(fraud_tier = 'CRITICAL') AS critical_count,
       {_r("100.0D * count_if(fraud_tier = 'CRITICAL') / count(*)", 2)} AS critical_pct,
       {_r('avg(fraud_score_ensemble)', 4)} AS avg_ensemble_score,
       {_r(MONEY.format(c='total_drug_cost') + ' / 1e6D', 1)} AS total_cost_M,
       {_r(MONEY.format(c="CASE WHEN fraud_tier = 'CRITICAL' THEN total_drug_cost ELSE 0.0D END") + ' / 1e6D', 1)}
           AS at_risk_cost_M
FROM providers GROUP BY state ORDER BY critical_pct DESC, state"""


def run_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    register_views(workspace(spark, sf_dir))
    return spark.sql(text)


def sql_queries() -> dict:
    return {
        "f7_state_concentration_sql": lambda s, d: run_sql(s, d, STATE_CONCENTRATION),
        "f8_oig_by_tier_sql": lambda s, d: run_sql(s, d, OIG_BY_TIER),
        "i4_geographic_clustering_sql": lambda s, d: run_sql(s, d, GEOGRAPHIC_CLUSTERING),
    }
