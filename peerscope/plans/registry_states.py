"""Registered queries on yearly refreshes: mergeable benchmark states and sketches, idempotent writes, rejected rows, the model bundle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.functions import round_half_even
from peerscope.models.bundle import Bundle
from peerscope.operators import clean as C
from peerscope.operators import states as T
from peerscope.operators.peers import BENCH_METRICS, BENCH_QUANTILES
from peerscope.plans import oracle as O
from peerscope.plans.layout import VIEWS, bucketed_views
from peerscope.plans.registry_checks import DIRTY, DIRTY_MULT, DIRTY_Q, _dirty, _folder
from peerscope.plans.registry_models import model_run
from peerscope.plans.views import workspace
from peerscope.sources import files as S

KEYS = ["specialty", "metric"]


def _years(ws) -> list[int]:
    found = ws.provider_years.select("data_year").where("data_year IS NOT NULL").distinct().collect()
    return sorted(r["data_year"] for r in found)        # one value a year


def _store(spark, sf_dir) -> T.BenchmarkStore:
    """Every year put on its own; the last one twice, as a corrected delivery would be."""
    ws = workspace(spark, sf_dir)
    store = T.BenchmarkStore(spark, _folder(spark, "states"))
    years = _years(ws)
    for y in [*years, *years[-1:]]:
        store.put(ws.provider_years.where(F.col("data_year") == y))
    return store


def _rounded(b: DataFrame, *extra) -> DataFrame:
    return b.select(*extra, *KEYS, "n_rows", "n", round_half_even("avg", 6).alias("avg"), round_half_even("std", 4).alias("std"))


def _without_year(spark, sf_dir) -> DataFrame:
    """The benchmarks of all years but one, for each year, by subtracting its states."""
    store = _store(spark, sf_dir)
    parts = [_rounded(store.benchmarks(without=y), F.lit(y).alias("left_out")) for y in _years(workspace(spark, sf_dir))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _sketch_quantiles(spark, sf_dir) -> DataFrame:
    """Quantiles of sketches merged over the years, held against all rows."""
    rows = workspace(spark, sf_dir).provider_years
    merged = T.merge_quantile_sketches(T.quantile_sketches(rows), KEYS)
    return T.sketch_rank_checks(rows, T.sketch_quantiles(merged, KEYS))


def _sketch_distinct(spark, sf_dir) -> DataFrame:
    """Distinct providers of a specialty over the years: united sketches within four standard errors of the exact count."""
    rows = workspace(spark, sf_dir).provider_years
    exact = rows.where("specialty IS NOT NULL AND data_year IS NOT NULL").groupBy("specialty").agg(F.count_distinct("npi").alias("n_npis"))
    found = T.distinct_counts(T.distinct_sketches(rows), ["specialty"])
    far = F.abs(F.col("n_estimated") - F.col("n_npis")) > F.lit(4 * T.hll_error()) * F.col("n_npis") + 1
    return exact.join(found, "specialty").select("specialty", "n_npis", (~far).alias("within"))


def _yearly_table(spark, sf_dir) -> str:
    """All years written as run 1; the last year corrected (one claim more a provider) and written as run 2, twice."""
    ws = workspace(spark, sf_dir)
    path = _folder(spark, "yearly")
    rows = ws.provider_years.select("npi", "data_year", "specialty", "total_claim_count")
    S.write_years(rows, path, run=1)
    corrected = rows.where(F.col("data_year") == _years(ws)[-1]).withColumn("total_claim_count", F.col("total_claim_count") + 1)
    for _ in range(2):
        S.write_years(corrected, path, run=2)
    return path


def _split(spark, sf_dir) -> tuple[DataFrame, DataFrame, dict]:
    return C.clean_with_counts(_dirty(workspace(spark, sf_dir)), _folder(spark, "cleaned"), outlier_q=DIRTY_Q, outlier_mult=DIRTY_MULT)


def _reject_counts(spark, sf_dir) -> DataFrame:
    """Rows per reason in the rejected table, and what was observed while writing."""
    _, rejected, seen = _split(spark, sf_dir)
    observed = spark.createDataFrame([(r, int(seen[r])) for r in C.REJECT_REASONS], "reject_reason string, n_observed long")
    return observed.join(rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows")), "reject_reason", "left").na.fill(0, ["n_rows"])


def _kept_rows(spark, sf_dir) -> DataFrame:
    from peerscope.plans.registry_checks import CLEAN_COLUMNS
    return C.to_provider_table(_split(spark, sf_dir)[0]).select(*CLEAN_COLUMNS)


def _bundle_scores(spark, sf_dir) -> DataFrame:
    """All providers scored from the reloaded bundle alone: rows, rows that differ from the run's isolation scores, rows
    whose blend, tier or flag does not follow from the scores."""
    run = model_run(spark, sf_dir)
    path = _folder(spark, "bundle")
    run.save_bundle(path)
    bundle = Bundle(path, spark)
    from peerscope.models import boost as B
    scored = bundle.score(run.matrix).join(run.isolation.withColumnRenamed("fraud_score_iso", "iso"), "npi").join(
        B.predict(run.final_model, run.matrix).withColumnRenamed("fraud_score_xgb", "xgb"), "npi")
    blend = F.lit(0.6) * F.col("xgb") + F.lit(0.4) * F.col("iso")
    return scored.agg(
        F.count(F.lit(1)).alias("n_scored"), F.count_if(F.abs(F.col("iso") - F.col("fraud_score_iso")) > 1e-12).alias("n_other_iso"),
        F.count_if(F.col("xgb") != F.col("fraud_score_xgb")).alias("n_other_xgb"),
        F.count_if(F.abs(F.col("fraud_score_ensemble") - blend) > 1e-12).alias("n_other_blend"),
        F.count_if(F.col("flagged") != (F.col("xgb") >= bundle.settings["threshold"])).alias("n_other_flags"))


def state_queries() -> dict:
    return {
        "a1_merged_year_benchmarks": lambda s, d: _rounded(_store(s, d).benchmarks()),
        "a1_benchmarks_without_year": _without_year,
        "a1_sketch_quantiles": _sketch_quantiles,
        "a6_sketch_distinct": _sketch_distinct,
        "s6_yearly_rewrite": lambda s, d: S.read_years(s, _yearly_table(s, d)),
        "s9_write_manifest": lambda s, d: S.read_manifest(s, _yearly_table(s, d)),
        "c1_c6_reject_counts": _reject_counts,
        "c1_c8_kept_rows": _kept_rows,
        "s10_raw_without_features": lambda s, d: workspace(s, d).providers_raw.select("npi").join(
            workspace(s, d).provider_features.select("npi"), "npi", "left_anti"),
        "s15_bundle_scores": _bundle_scores,
        "j2_j3_colocated_scored": lambda s, d: bucketed_views(workspace(s, d)).scored(),
        "j1_colocated_flagged": lambda s, d: bucketed_views(workspace(s, d)).flagged(),
        "j4_colocated_exclusions": lambda s, d: bucketed_views(workspace(s, d)).excluded(),
        "c13_lookup_buckets": lambda s, d: bucketed_views(workspace(s, d)).placements(),
    }


def state_sql() -> dict:
    from peerscope.plans.registry_checks import _clean_sql
    longs = " UNION ALL ".join(f"SELECT npi, specialty, data_year, '{m}' AS metric, CAST({m} AS DOUBLE) AS x FROM provider_years" for m in BENCH_METRICS)
    long = f", long AS (SELECT * FROM ({longs}) WHERE specialty IS NOT NULL AND data_year IS NOT NULL)"
    stats = f"count(*) AS n_rows, count(x) AS n, {O.rnd('avg(x)', 6)} AS avg, {O.rnd('stddev_samp(x)', 4)} AS std"
    names = ", ".join(f"('{q}')" for q in BENCH_QUANTILES)
    last = "(SELECT max(data_year) FROM provider_years)"

    def num(c):
        v = f"TRY_CAST(trim({c}) AS DOUBLE)"
        return f"CASE WHEN isfinite({v}) THEN {v} END"

    dirty = ", ".join(f"{e} AS {c}" for c, e in DIRTY.items())
    blank = "regexp_replace(npi, '^[\\s\\x{A0}]+|[\\s\\x{A0}]+$', '', 'g')"
    reasons = ", ".join(f"('{r}')" for r in C.REJECT_REASONS)
    tables = {"exclusions": "oig_exclusions", "alerts": "fraud_alerts"}
    stored = " UNION ALL ".join(f"SELECT '{v}' AS view, count(*) AS n_rows, 0::BIGINT AS n_astray, 0::BIGINT AS n_split_keys FROM {tables.get(v, v)}" for v in VIEWS)
    return {
        "a1_merged_year_benchmarks": O.q(f"{long} SELECT specialty, metric, {stats} FROM long GROUP BY specialty, metric"),
        "a1_benchmarks_without_year": O.q(f"""{long}
, y AS (SELECT DISTINCT data_year AS left_out FROM provider_years WHERE data_year IS NOT NULL)
SELECT left_out, specialty, metric, {stats} FROM long JOIN y ON data_year <> left_out GROUP BY left_out, specialty, metric"""),
        "a1_sketch_quantiles": O.q(f"""{long}
SELECT specialty, metric, quantile, count(*) AS n, TRUE AS within FROM long, (VALUES {names}) AS q(quantile) WHERE x IS NOT NULL GROUP BY ALL"""),
        "a6_sketch_distinct": O.q("""
SELECT specialty, count(DISTINCT npi) AS n_npis, TRUE AS within FROM provider_years WHERE specialty IS NOT NULL AND data_year IS NOT NULL GROUP BY specialty"""),
        "s6_yearly_rewrite": O.q(f"""
SELECT npi, specialty, total_claim_count + CASE WHEN data_year = {last} THEN 1 ELSE 0 END AS total_claim_count, data_year FROM provider_years"""),
        "s9_write_manifest": O.q(f"""
SELECT data_year, CASE WHEN data_year = {last} THEN 2 ELSE 1 END AS run, count(*) AS n_rows FROM provider_years GROUP BY data_year"""),
        "c1_c6_reject_counts": O.q(f"""
, marked AS (SELECT *, {num('total_claim_count')} AS claims, {num('total_beneficiaries')} AS benes, {blank} AS bare, coalesce({num('total_drug_cost')}, 0) AS cost
             FROM (SELECT {dirty} FROM (SELECT *, CAST(substr(npi, 2) AS BIGINT) AS k FROM raw))),
named AS (SELECT *, CASE WHEN claims IS NULL THEN 'claims_not_a_number' WHEN claims < 11 THEN 'claims_suppressed'
    WHEN benes IS NULL THEN 'beneficiaries_not_a_number' WHEN benes < 11 THEN 'beneficiaries_suppressed'
    WHEN coalesce(bare, '') = '' THEN 'npi_missing' WHEN NOT regexp_full_match(bare, '[12][0-9]{{9}}') THEN 'npi_malformed' END AS early FROM marked),
q AS (SELECT specialty_description AS sd, quantile_cont(cost, {DIRTY_Q}) AS q FROM named WHERE early IS NULL GROUP BY 1),
final AS (SELECT coalesce(early, CASE WHEN cost > q * {DIRTY_MULT} THEN 'cost_outlier' END) AS reject_reason FROM named LEFT JOIN q ON specialty_description = sd)
SELECT v.r AS reject_reason, count(reject_reason) AS n_observed, count(reject_reason) AS n_rows
FROM (VALUES {reasons}) AS v(r) LEFT JOIN final ON final.reject_reason = v.r GROUP BY v.r"""),
        "c1_c8_kept_rows": O.q(_clean_sql()),
        "s10_raw_without_features": O.q("SELECT npi FROM raw WHERE npi NOT IN (SELECT npi FROM provider_features)"),
        "s15_bundle_scores": O.q("""
SELECT count(*) AS n_scored, 0::BIGINT AS n_other_iso, 0::BIGINT AS n_other_xgb, 0::BIGINT AS n_other_blend, 0::BIGINT AS n_other_flags FROM providers"""),
        "j2_j3_colocated_scored": O.q("SELECT * FROM providers"),
        "j1_colocated_flagged": O.q("""
SELECT npi, p.specialty, p.state, p.total_drug_cost, f.flag_count, f.pct_total_claim_count, f.pct_total_drug_cost, f.pct_cost_per_claim, f.pct_brand_share
FROM providers p JOIN provider_features f USING (npi) WHERE f.flag_count >= 1"""),
        "j4_colocated_exclusions": O.q("""
SELECT npi, specialty, state, coalesce(n, 0) AS n_exclusions, first_excluded
FROM providers LEFT JOIN (SELECT npi, count(*) AS n, min(exclusion_date) AS first_excluded FROM oig_exclusions GROUP BY npi) USING (npi)"""),
        "c13_lookup_buckets": O.q(stored),
    }
