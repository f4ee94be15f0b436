"""Registered model jobs (isolation scores, oversampling, boosted scores, tiers, attributions).

Neighbour search, oversampling, folds, scaling and the isolation forest (all its draws are hashes) have SQL.  The boosted
models have none; what must hold of their outputs is counted by ``m5_m9_model_invariants``, whose expected row SQL can give."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.functions import round_half_even
from peerscope.operators.peers import FEATURE_COLUMNS
from peerscope.operators.scoring import minmax_scale
from peerscope.plans import oracle as O
from peerscope.plans.models import ModelParams, ModelRun
from peerscope.plans.registry_reports import FOLDS_SQL
from peerscope.plans.views import workspace

# The original settings throughout: 400 boosting rounds, five folds, 200 isolation trees.
PARAMS = ModelParams()

_RUNS: dict[int, ModelRun] = {}


def model_run(spark, sf_dir) -> ModelRun:
    ws = workspace(spark, sf_dir)
    run = _RUNS.get(id(ws))
    if run is None:
        run = _RUNS[id(ws)] = ModelRun(ws.features, PARAMS)
    return run


def _knn(spark, sf_dir) -> DataFrame:
    knn = model_run(spark, sf_dir).knn
    return knn.select("npi", "nn_rank", "nn_key", round_half_even("dist", 6).alias("dist"))


def _smote(spark, sf_dir) -> DataFrame:
    rows = model_run(spark, sf_dir).smote_rows
    return rows.select("npi", "is_fraud_label", *[round_half_even(c, 4).alias(c) for c in FEATURE_COLUMNS])


def _one_row_checks(spark, sf_dir) -> DataFrame:
    """Invariants of the model outputs, counted over all rows: scores in [0, 1], isolation scores that reach both
    ends, tiers and blend recomputed from the scores, attributions that add up, reasons that name the
    strongest impacts."""
    run = model_run(spark, sf_dir)
    s = run.scores
    blend = F.lit(0.6) * F.col("fraud_score_xgb") + F.lit(0.4) * F.col("fraud_score_iso")
    tier = (F.when(blend >= 0.8, "CRITICAL").when(blend >= 0.6, "HIGH").when(blend >= 0.4, "MODERATE").otherwise("LOW"))
    a = s.agg(F.count(F.lit(1)).alias("n_scores"),
              F.count_if((F.col("fraud_score_xgb") < 0) | (F.col("fraud_score_xgb") > 1)).alias("n_bad_range"),
              F.min("fraud_score_iso").alias("iso_min"), F.max("fraud_score_iso").alias("iso_max"),
              F.count_if(~F.col("fraud_tier").eqNullSafe(tier) | (F.abs(F.col("fraud_score_ensemble") - blend) > 1e-12)).alias("n_bad_tiers"))
    total = run.attributions
    impacts = F.aggregate(F.array(*[F.col(f"i_{c}") for c in FEATURE_COLUMNS]), F.lit(0.0), lambda acc, x: acc + x)
    b = total.agg(F.count(F.lit(1)).alias("n_explained"),
                  F.count_if(F.abs(F.col("log_odds") - F.col("base_value") - impacts) > 1e-6).alias("n_not_additive"))
    largest = F.array_max(F.array(*[F.abs(F.col(f"i_{c}")) for c in FEATURE_COLUMNS]))
    named = F.coalesce(*[F.when(F.col("reason_1").startswith(f"{c}:"), F.abs(F.col(f"i_{c}"))) for c in FEATURE_COLUMNS])
    c = run.reasons.join(total, "npi").agg(F.count_if(~F.coalesce(named == largest, F.lit(False))).alias("n_bad_reasons"))
    return a.crossJoin(b).crossJoin(c)      # one row each


def _isolation_checks(spark, sf_dir) -> DataFrame:
    """Invariants of the isolation scores alone: one for each provider, from 0 to 1, both ends reached."""
    return model_run(spark, sf_dir).isolation.agg(
        F.count(F.lit(1)).alias("n_scores"), F.count_distinct("npi").alias("n_npis"),
        F.count_if(~F.coalesce(F.col("fraud_score_iso").between(0.0, 1.0), F.lit(False))).alias("n_bad_range"),
        F.min("fraud_score_iso").alias("iso_min"), F.max("fraud_score_iso").alias("iso_max"))


def _oof_folds(spark, sf_dir) -> DataFrame:
    """Every provider is scored once, by the models of the other folds."""
    return model_run(spark, sf_dir).out_of_fold.select(
        "npi", F.col("fold").cast("int").alias("fold"), F.col("fraud_score_xgb").between(0.0, 1.0).alias("in_range"))


def isolation_sql(p: ModelParams) -> str:
    """The isolation forest grown level by level: ``w{d}`` holds every row of every tree in its node of depth ``d``, ``s{d}`` the
    split of each node that the sampled rows (``own``) still divide.  Trees are no deeper than ceil(log2(samples))."""
    depth = math.ceil(math.log2(max(p.iso_samples, 2)))
    word = "CAST(('0x' || substr(md5({t}), {k}, 8)) AS BIGINT)"
    cols = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0)" for c in FEATURE_COLUMNS)
    levels = []
    for d in range(depth):
        node = "'42-' || tree || '-' || node"
        levels.append(f"""
s{d} AS MATERIALIZED (SELECT tree, node, f, lo + {word.format(t=node, k=9)} / 4294967296.0::DOUBLE * (hi - lo) AS thr FROM limits, (
  SELECT *, row_number() OVER (PARTITION BY tree, node ORDER BY f) - 1 AS i, count(*) OVER (PARTITION BY tree, node) AS m FROM (
    SELECT tree, node, f, min(x[f]) AS lo, max(x[f]) AS hi FROM w{d} JOIN x USING (npi), (SELECT unnest(range(1, {len(FEATURE_COLUMNS) + 1})) AS f)
    WHERE own AND node > 0 GROUP BY ALL) WHERE hi > lo) WHERE {d} < limits.depth AND i = {word.format(t=node, k=1)} * m // 4294967296),
n{d} AS MATERIALIZED (SELECT tree, node, count(*) FILTER (WHERE own) AS size FROM w{d} GROUP BY ALL),
w{d + 1} AS MATERIALIZED (SELECT tree, npi, own, CASE WHEN f IS NULL THEN 0 WHEN x[f] <= thr THEN 2 * node ELSE 2 * node + 1 END AS node,
    CASE WHEN f IS NULL AND node > 0 THEN {d} ELSE d END AS d, CASE WHEN f IS NULL AND node > 0 THEN size ELSE last END AS last
  FROM w{d} JOIN x USING (npi) JOIN n{d} USING (tree, node) LEFT JOIN s{d} USING (tree, node)),""")
    length = "CASE WHEN {s} = 2 THEN 1.0::DOUBLE WHEN {s} > 2 THEN 2.0 * (ln({s} - 1.0::DOUBLE) + 0.5772156649015329::DOUBLE) - 2.0 * ({s} - 1) / {s}::DOUBLE ELSE 0.0::DOUBLE END"
    return O.q(f"""
, x AS MATERIALIZED (SELECT npi, [{cols}] AS x, CAST(('0x' || substr(md5(npi), 1, 8)) AS BIGINT) % 2147483647 AS h FROM feat2),
limits AS MATERIALIZED (SELECT least({p.iso_samples}, count(*)) AS psi, ceil(log2(greatest(least({p.iso_samples}, count(*)), 2))) AS depth FROM x),
t AS MATERIALIZED (SELECT tree, 1 + {word.format(t="'42-' || tree", k=1)} % 2147483646 AS a, {word.format(t="'42-' || tree", k=9)} % 2147483647 AS b
  FROM (SELECT unnest(range({p.iso_trees})) AS tree)),
w0 AS MATERIALIZED (SELECT tree, npi, row_number() OVER (PARTITION BY tree ORDER BY (a * h + b) % 2147483647, npi) <= psi AS own,
    1::BIGINT AS node, 0 AS d, 0::BIGINT AS last FROM x, t, limits),{"".join(levels)}
n{depth} AS (SELECT tree, node, count(*) FILTER (WHERE own) AS size FROM w{depth} GROUP BY ALL),
p AS (SELECT npi, CASE WHEN node > 0 THEN {depth} ELSE d END AS d, CASE WHEN node > 0 THEN size ELSE last END AS s FROM w{depth} JOIN n{depth} USING (tree, node)),
e AS (SELECT npi, sum(CAST(round_even((d + {length.format(s="s")}) * 1e9::DOUBLE, 0) AS BIGINT))::DOUBLE / 1e9::DOUBLE / {p.iso_trees} AS eh FROM p GROUP BY npi),
r AS (SELECT npi, power(2.0::DOUBLE, -eh / {length.format(s="psi")}) AS raw FROM e, limits),
m AS (SELECT min(raw) AS lo, max(raw) AS hi FROM r)
SELECT npi, {O.rnd('(raw - lo) / (hi - lo)', 8)} AS fraud_score_iso FROM r, m""")


def model_queries() -> dict:
    return {
        "m3_minority_knn": _knn,
        "m3_smote_rows": _smote,
        "m5_isolation_scores": lambda s, d: model_run(s, d).isolation.select(
            "npi", round_half_even("fraud_score_iso", 8).alias("fraud_score_iso")),
        "m5_isolation_invariants": _isolation_checks,
        "m4_oof_scores": lambda s, d: model_run(s, d).out_of_fold,
        "m7_model_tiers": lambda s, d: model_run(s, d).scores,
        "m8_attributions": lambda s, d: model_run(s, d).attribution_long(),
        "m9_model_reasons": lambda s, d: model_run(s, d).reasons,
        "m4_oof_folds": _oof_folds,
        "m5_m9_model_invariants": _one_row_checks,
        "m6_minmax_scale": lambda s, d: minmax_scale(
            workspace(s, d).providers.select("npi", "total_drug_cost"), "total_drug_cost", "scaled").select("npi", round_half_even("scaled", 10).alias("scaled")),
    }


def model_sql() -> dict:
    cols = ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in FEATURE_COLUMNS)
    dist = "sqrt(0.0::DOUBLE " + "".join(f" + (a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATURE_COLUMNS) + ")"
    knn = f"""
, mino AS (SELECT npi, {cols} FROM feat2 WHERE is_fraud_label = 1),
d AS (SELECT a.npi, b.npi AS nn_key, {dist} AS dist FROM mino a JOIN mino b ON a.npi <> b.npi),
r AS (SELECT *, row_number() OVER (PARTITION BY npi ORDER BY dist, nn_key) AS nn_rank FROM d)"""
    unit = "CAST(('0x' || substr(md5('42-' || j || '-{k}'), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE"
    drawn = ", ".join(f"{O.rnd(f'(a.{c} + u3 * (b.{c} - a.{c}))', 4)} AS {c}" for c in FEATURE_COLUMNS)
    return {
        "m3_minority_knn": O.q(knn + f"""
SELECT npi, CAST(nn_rank AS INTEGER) AS nn_rank, nn_key, {O.rnd('dist', 6)} AS dist FROM r WHERE nn_rank <= 5"""),
        "m3_smote_rows": O.q(knn + f"""
, c AS (SELECT count(*) FILTER (WHERE is_fraud_label = 0) AS n0, count(*) FILTER (WHERE is_fraud_label = 1) AS n1 FROM feat2),
ord AS (SELECT *, row_number() OVER (ORDER BY CAST(('0x' || substr(md5(npi), 1, 8)) AS BIGINT), npi) - 1 AS idx FROM mino),
j AS (SELECT unnest(range(greatest(n0 - n1, 0))) AS j, n1 FROM c),
u AS (SELECT j, CAST(floor({unit.format(k=1)} * n1) AS BIGINT) AS idx,
             CAST(floor({unit.format(k=2)} * least(5, n1 - 1)) AS BIGINT) + 1 AS nn_rank, {unit.format(k=3)} AS u3 FROM j)
SELECT 'synthetic-' || u.j AS npi, 1 AS is_fraud_label, {drawn}
FROM u JOIN ord a ON u.idx = a.idx JOIN r ON r.npi = a.npi AND r.nn_rank = u.nn_rank JOIN mino b ON b.npi = r.nn_key"""),
        "m4_oof_folds": O.q(FOLDS_SQL + "SELECT npi, CAST(fold AS INTEGER) AS fold, TRUE AS in_range FROM folds"),
        "m5_isolation_scores": isolation_sql(PARAMS),
        "m5_isolation_invariants": O.q("""
SELECT count(*) AS n_scores, count(DISTINCT npi) AS n_npis, 0::BIGINT AS n_bad_range, 0.0::DOUBLE AS iso_min, 1.0::DOUBLE AS iso_max FROM providers"""),
        "m5_m9_model_invariants": O.q("""
SELECT count(*) AS n_scores, 0::BIGINT AS n_bad_range, 0.0::DOUBLE AS iso_min, 1.0::DOUBLE AS iso_max, 0::BIGINT AS n_bad_tiers,
       least(500, count(*))::BIGINT AS n_explained, 0::BIGINT AS n_not_additive, 0::BIGINT AS n_bad_reasons
FROM providers"""),
        "m6_minmax_scale": O.q(f"""
, m AS (SELECT min(total_drug_cost) AS lo, max(total_drug_cost) AS hi FROM providers)
SELECT npi, {O.rnd('(total_drug_cost - lo) / (hi - lo)', 10)} AS scaled FROM providers, m"""),
    }
