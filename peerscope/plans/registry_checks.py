"""Registered queries on awkward inputs: dirty text columns, files with shuffled headers, repeated and missing
keys, several years of one provider, filters and sort orders.

The inputs are derived from the driver's tables in both engines, so every rule has rows that violate it.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.functions import round_half_even
from peerscope.operators import clean as C
from peerscope.operators import peers as P
from peerscope.operators import reports as R
from peerscope.plans import oracle as O
from peerscope.plans.views import workspace
from peerscope.session import ensure_checkpoint_dir, materialize
from peerscope.sources import files as S

# Fixture parameters under which the outlier rule fires (0.999 and 20 in the operator).
DIRTY_Q, DIRTY_MULT = 0.5, 1.5
YEARS = (1999, 2000)
STATES, SPECIALTIES = ("NATION_1", "NATION_3", "NATION_7", "NATION_12"), ("Building", "Machinery")
SORTS = ("critical_count", "avg_fraud_score", "total_drug_cost_m")
CLEAN_COLUMNS = ["npi", "state", "specialty", "total_claim_count", "total_drug_cost", "total_beneficiaries", "brand_claim_count",
                 "cost_per_claim", "brand_share", "claims_per_bene"]

#: Dirty text columns from the raw provider rows; the same expressions run in both engines (k: customer number).
DIRTY = {
    "npi": "CASE k % 11 WHEN 0 THEN concat(chr(160), npi, ' ') WHEN 1 THEN concat('X', substr(npi, 2)) WHEN 2 THEN substr(npi, 2) ELSE npi END",
    "nppes_provider_last_org_name": "nppes_provider_last_org_name",
    "nppes_provider_first_name": "nppes_provider_first_name",
    "nppes_provider_state": "nppes_provider_state",
    "specialty_description": "CASE k % 3 WHEN 0 THEN concat('  ', lower(specialty_description), ' o''neil-unit ') ELSE specialty_description END",
    "total_claim_count": "CASE k % 7 WHEN 0 THEN '*' WHEN 1 THEN '' WHEN 2 THEN concat(' ', CAST(total_claim_count AS VARCHAR(20)), ' ') ELSE CAST(total_claim_count AS VARCHAR(20)) END",
    "total_drug_cost": "CASE k % 17 WHEN 3 THEN 'n/a' ELSE CAST(CAST(total_drug_cost AS DECIMAL(18,2)) AS VARCHAR(20)) END",
    "total_beneficiaries": "CASE k % 13 WHEN 5 THEN 'nan' WHEN 6 THEN 'inf' ELSE CAST(total_beneficiaries AS VARCHAR(20)) END",
    "brand_claim_count": "CASE k % 5 WHEN 0 THEN 'inf' WHEN 1 THEN 'abc' ELSE CAST(brand_claim_count AS VARCHAR(20)) END",
    "generic_claim_count": "CAST(generic_claim_count AS VARCHAR(20))",
    "opioid_claim_count": "CAST(opioid_claim_count AS VARCHAR(20))",
}


def _dirty(ws) -> DataFrame:
    raw = ws.providers_raw.withColumn("k", F.substring("npi", 2, 9).cast("long"))
    return raw.select(*[F.expr(e).alias(c) for c, e in DIRTY.items()])


def _cleaned(raw: DataFrame) -> DataFrame:
    return C.to_provider_table(C.clean_providers(raw, outlier_q=DIRTY_Q, outlier_mult=DIRTY_MULT)).select(*CLEAN_COLUMNS)


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/peerscope/{name}-{uuid.uuid4().hex}"


def _providers_csv(spark, sf_dir) -> DataFrame:
    """Dirty rows written as CSV with columns in another order and two extra ones, read back by name and cleaned."""
    path = _folder(spark, "csv")
    _dirty(workspace(spark, sf_dir)).select(
        F.lit("x").alias("extra_first"), *reversed(list(DIRTY)), F.lit(1).alias("extra last")).write.option("header", True).csv(path)
    return _cleaned(S.read_providers_csv(spark, path))


def _exclusions_csv(spark, sf_dir) -> DataFrame:
    """The exclusion list in the public file's layout (Latin-1, yyyyMMdd), read back by name."""
    path = _folder(spark, "csv")
    (workspace(spark, sf_dir).exclusions.select(
        F.lit("DOÉ").alias("LASTNAME"), F.lit("J").alias("FIRSTNAME"), F.lit("général").alias("GENERAL"), F.col("npi").alias("NPI"),
        F.lit("1128a1").alias("EXCLTYPE"), F.date_format("exclusion_date", "yyyyMMdd").alias("EXCLDATE"), F.lit("00000000").alias("REINDATE"))
     .write.option("header", True).option("encoding", "ISO-8859-1").csv(path))
    return S.read_exclusions_csv(spark, path).select("npi", "exclusion_date", "exclusion_type", "general", F.col("reinstatement_date").isNull().alias("active"))


def _yearly_files(spark, years: DataFrame, wanted, name: str) -> DataFrame:
    paths = {}
    for y in wanted:
        paths[y] = _folder(spark, f"year_{y}")
        years.where(F.col("data_year") == y).drop("data_year").write.parquet(paths[y])
    return materialize(S.read_multi_year(spark, paths), name)


@lru_cache(maxsize=None)
def _two_years(spark, sf_dir) -> DataFrame:
    """Two yearly files of the providers, read as one table keyed by npi and data_year."""
    return _yearly_files(spark, workspace(spark, sf_dir).provider_years, YEARS, "two_years")


@lru_cache(maxsize=None)
def _all_years(spark, sf_dir) -> DataFrame:
    """A yearly file for each year there is, read as one table keyed by npi and data_year; no rows without years."""
    years = workspace(spark, sf_dir).provider_years
    found = sorted(r["data_year"] for r in years.select("data_year").where("data_year IS NOT NULL").distinct().collect())
    return _yearly_files(spark, years, found, "all_years") if found else years


def _year_features(years: DataFrame) -> DataFrame:
    key = ("npi", "data_year")
    _, feats = P.build_features(years, key=key)
    return P.provider_features_table(feats, key=key).select(*key, "specialty", *[f"pct_{m}" for m in P.PCT_METRICS], "flag_count")


def _profile(spark, sf_dir) -> DataFrame:
    path = _folder(spark, "csv")
    _dirty(workspace(spark, sf_dir)).write.option("header", True).csv(path)
    there = S.profile_path(spark, path, ["npi", "no_such_column"])
    gone = S.profile_path(spark, path + "-missing", ["npi"])
    return there.unionByName(gone).select(
        "exists_flag", (F.col("size_bytes") > 0).alias("has_bytes"), "n_rows", "n_columns",
        F.coalesce(F.array_join("missing_columns", ","), F.lit("")).alias("missing_columns"), F.size("sample_rows").cast("long").alias("n_sample"))


def _optional(spark, sf_dir) -> DataFrame:
    """Rows of a scores table that exists and of one that does not yet."""
    ws = workspace(spark, sf_dir)
    path = _folder(spark, "scores")
    ws.scores.write.parquet(path)
    counts = [S.read_optional(spark, p, ws.scores.schema).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("source", F.lit(n))
              for n, p in (("present", path), ("missing", path + "-missing"))]
    return counts[0].unionByName(counts[1])


def _lookup(spark, sf_dir) -> DataFrame:
    """C13 for the smallest npi with blanks around it, C19 with the model columns of a provider never scored."""
    scored = workspace(spark, sf_dir).providers_scored
    npi = scored.agg(F.min("npi")).first()[0]
    columns = ["npi", "specialty", "fraud_score_ensemble", "fraud_score_xgb", "fraud_score_iso", "fraud_tier", "flag_count"]
    blank = scored.withColumns({c: F.lit(None).cast(scored.schema[c].dataType) for c in columns[2:]})
    found = R.lookup(scored, f"  {npi} ").select(*columns, F.lit("scored").alias("state_of_row"))
    return found.unionByName(R.lookup(blank, npi).select(*columns, F.lit("unscored").alias("state_of_row")))


def check_queries() -> dict:
    w = workspace
    return {
        "c1_c8_clean_dirty": lambda s, d: _cleaned(_dirty(w(s, d))),
        "s1_providers_csv": _providers_csv,
        "s11_exclusions_csv": _exclusions_csv,
        "s12_two_year_rows": lambda s, d: _two_years(s, d).select("npi", "data_year", "total_claim_count", "cost_per_claim"),
        "s8_w7_two_year_features": lambda s, d: _year_features(_two_years(s, d)),
        "s12_all_year_rows": lambda s, d: _all_years(s, d).select("npi", "data_year", "total_claim_count", "cost_per_claim"),
        "s8_w7_all_year_features": lambda s, d: _year_features(_all_years(s, d)),
        "s13_source_profile": _profile,
        "s3_optional_source": _optional,
        "s10_repeated_exclusions": lambda s, d: w(s, d).exclusions.groupBy("npi").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1"),
        "s10_missing_features": lambda s, d: w(s, d).providers.select("npi").join(
            w(s, d).provider_features.where("flag_count = 0").select("npi"), "npi", "left_anti"),
        "c13_c19_lookup": _lookup,
        "c14_filters": lambda s, d: R.filter_high_risk(w(s, d).providers_scored, states=STATES, specialties=SPECIALTIES).select(
            "npi", "state", "specialty", "fraud_tier"),
        "c18_state_display": lambda s, d: R.state_display(w(s, d).providers_scored),
        "c18_lookup_metrics": lambda s, d: R.lookup_metrics(w(s, d).providers_scored),
        "d16_labelled_reasons": lambda s, d: R.labelled_reasons(w(s, d).reasons),
        **{f"l8_states_by_{c}": (lambda s, d, c=c: R.state_table(w(s, d).providers_scored, c)) for c in SORTS},
    }


def _clean_sql() -> str:
    def num(c):
        v = f"TRY_CAST(trim({c}) AS DOUBLE)"
        return f"CASE WHEN isfinite({v}) THEN {v} END"

    counts = ", ".join(f"CAST(coalesce({num(c)}, 0) AS BIGINT) AS {c}" for c in
                       ("total_claim_count", "total_beneficiaries", "brand_claim_count", "generic_claim_count", "opioid_claim_count"))
    dirty = ", ".join(f"{e} AS {c}" for c, e in DIRTY.items())
    return f"""
, dirty AS (SELECT {dirty} FROM (SELECT *, CAST(substr(npi, 2) AS BIGINT) AS k FROM raw)),
kept AS (SELECT regexp_replace(npi, '^[\\s\\x{{A0}}]+|[\\s\\x{{A0}}]+$', '', 'g') AS npi, nppes_provider_state AS state, specialty_description,
                {counts}, coalesce({num('total_drug_cost')}, 0) AS total_drug_cost
         FROM dirty WHERE {num('total_claim_count')} >= 11 AND {num('total_beneficiaries')} >= 11),
valid AS (SELECT * FROM kept WHERE regexp_full_match(npi, '[12][0-9]{{9}}')),
mid AS (SELECT specialty_description AS sd, quantile_cont(total_drug_cost, {DIRTY_Q}) AS q FROM valid GROUP BY 1)
SELECT npi, state, {O.title('specialty_description')} AS specialty, total_claim_count, total_drug_cost, total_beneficiaries, brand_claim_count,
       {O.ratio('total_drug_cost', 'total_claim_count', 2)} AS cost_per_claim, {O.ratio('brand_claim_count', 'total_claim_count', 4)} AS brand_share,
       {O.ratio('total_claim_count', 'total_beneficiaries', 2)} AS claims_per_bene
FROM valid JOIN mid ON specialty_description = sd WHERE NOT total_drug_cost > q * {DIRTY_MULT}"""


def check_sql() -> dict:
    from peerscope.plans.registry_reports import _state_table_sql
    years = ", ".join(map(str, YEARS))
    pct = ", ".join(
        f"CASE WHEN {m} IS NULL OR specialty IS NULL THEN NULL ELSE " + O.rnd(
            f"(rank() OVER (PARTITION BY specialty ORDER BY {m}) + (count(*) OVER (PARTITION BY specialty, {m}) - 1) / 2.0::DOUBLE) "
            f"/ count({m}) OVER (PARTITION BY specialty)", 4) + f" END AS pct_{m}" for m in P.PCT_METRICS)
    high = "coalesce(CAST({} AS INTEGER), 0)"
    flags = " + ".join(high.format(x) for x in (
        "y.total_claim_count > b.p99c", "y.cost_per_claim > b.p99k", "y.brand_share > 0.70", "y.claims_per_bene > b.p95b", "y.opioid_share > 0.20"))
    states, specialties = (", ".join(f"'{x}'" for x in v) for v in (STATES, SPECIALTIES))
    n_columns = len(DIRTY)
    return {
        "c1_c8_clean_dirty": O.q(_clean_sql()),
        "s1_providers_csv": O.q(_clean_sql()),
        "s11_exclusions_csv": O.q("SELECT npi, exclusion_date, '1128a1' AS exclusion_type, 'général' AS general, TRUE AS active FROM oig_exclusions"),
        "s12_two_year_rows": O.q(f"SELECT npi, data_year, total_claim_count, cost_per_claim FROM provider_years WHERE data_year IN ({years})"),
        "s8_w7_two_year_features": O.q(f"""
, y AS (SELECT *, {pct} FROM provider_years WHERE data_year IN ({years})),
b AS (SELECT specialty, quantile_cont(total_claim_count, 0.99) AS p99c, quantile_cont(cost_per_claim, 0.99) AS p99k,
             quantile_cont(claims_per_bene, 0.95) AS p95b FROM y GROUP BY specialty)
SELECT y.npi, y.data_year, y.specialty, {', '.join(f'y.pct_{m}' for m in P.PCT_METRICS)}, {flags} AS flag_count
FROM y LEFT JOIN b ON y.specialty = b.specialty"""),
        "s12_all_year_rows": O.q("SELECT npi, data_year, total_claim_count, cost_per_claim FROM provider_years"),
        "s8_w7_all_year_features": O.q(f"""
, y AS (SELECT *, {pct} FROM provider_years),
b AS (SELECT specialty, quantile_cont(total_claim_count, 0.99) AS p99c, quantile_cont(cost_per_claim, 0.99) AS p99k,
             quantile_cont(claims_per_bene, 0.95) AS p95b FROM y GROUP BY specialty)
SELECT y.npi, y.data_year, y.specialty, {', '.join(f'y.pct_{m}' for m in P.PCT_METRICS)}, {flags} AS flag_count
FROM y LEFT JOIN b ON y.specialty = b.specialty"""),
        "s13_source_profile": O.q(f"""
SELECT TRUE AS exists_flag, TRUE AS has_bytes, count(*) AS n_rows, {n_columns} AS n_columns, 'no_such_column' AS missing_columns,
       least(5, count(*))::BIGINT AS n_sample FROM raw
UNION ALL SELECT FALSE, FALSE, NULL, NULL, '', NULL"""),
        "s3_optional_source": O.q("SELECT 'present' AS source, count(*) AS n_rows FROM scores UNION ALL SELECT 'missing', 0"),
        "s10_repeated_exclusions": O.q("SELECT npi, count(*) AS n_rows FROM oig_exclusions GROUP BY npi HAVING count(*) > 1"),
        "s10_missing_features": O.q("SELECT npi FROM providers WHERE npi NOT IN (SELECT npi FROM provider_features WHERE flag_count = 0)"),
        "c13_c19_lookup": O.q("""
, one AS (SELECT * FROM providers WHERE npi = (SELECT min(npi) FROM providers))
SELECT npi, specialty, coalesce(fraud_score_ensemble, 0.0) AS fraud_score_ensemble, coalesce(fraud_score_xgb, 0.0) AS fraud_score_xgb,
       coalesce(fraud_score_iso, 0.0) AS fraud_score_iso, coalesce(fraud_tier, 'UNKNOWN') AS fraud_tier, coalesce(flag_count, 0) AS flag_count,
       'scored' AS state_of_row FROM one
UNION ALL SELECT npi, specialty, 0.0, 0.0, 0.0, 'UNKNOWN', 0, 'unscored' FROM one"""),
        "c14_filters": O.q(f"""
SELECT npi, state, specialty, fraud_tier FROM providers
WHERE fraud_tier IN ('CRITICAL', 'HIGH') AND state IN ({states}) AND specialty IN ({specialties})"""),
        "c18_state_display": O.q(_state_table_sql(f"""
SELECT row_number() OVER (ORDER BY high_risk_pct DESC, state) AS rank, state AS State, total_providers AS Providers, critical_count AS CRITICAL,
       high_count AS HIGH, printf('%.1f%%', {O.rnd('high_risk_pct', 1)}) AS High_Risk_pct, printf('%.4f', avg_fraud_score) AS Avg_Score,
       printf('$%.1fM', total_drug_cost_m) AS Drug_Cost, oig_confirmed AS OIG_Confirmed FROM st""")),
        "c18_lookup_metrics": O.q(f"""
SELECT npi, 'Total Claims' AS metric, format('{{:,}}', total_claim_count) AS value FROM providers
UNION ALL SELECT npi, 'Total Drug Cost', printf('$%.0fK', {O.rnd('coalesce(total_drug_cost, 0) / 1000.0', 0)}) FROM providers
UNION ALL SELECT npi, 'Cost per Claim', printf('$%.0f', {O.rnd('coalesce(cost_per_claim, 0)', 0)}) FROM providers
UNION ALL SELECT npi, 'Brand Drug Share', printf('%.1f%%', {O.rnd('coalesce(brand_share, 0) * 100.0', 1)}) FROM providers
UNION ALL SELECT npi, 'Opioid Share', printf('%.1f%%', {O.rnd('coalesce(opioid_share, 0) * 100.0', 1)}) FROM providers"""),
        "d16_labelled_reasons": O.q(f"""
, named(feature, label) AS (VALUES {', '.join(f"('{k}', '{v}')" for k, v in R.FEATURE_LABELS.items())}),
lead AS (SELECT npi, split_part(reason_1, ':', 1) AS feature FROM fraud_alerts)
SELECT npi, feature, coalesce(label, feature) AS label FROM lead LEFT JOIN named USING (feature)"""),
        **{f"l8_states_by_{c}": O.q(_state_table_sql(
            f"SELECT *, row_number() OVER (ORDER BY {c} DESC, state) AS rank FROM st")) for c in SORTS},
    }
