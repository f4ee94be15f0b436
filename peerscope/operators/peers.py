"""Peer-group features: specialty benchmarks, z-scores, percentile ranks, rule flags.

Every provider is compared with the providers of its own specialty.  Group
statistics are computed once with map-side aggregation and joined back
(a broadcast behind a row-count check), never with a one-task window;
order statistics (quantiles, percentile ranks) use ``ordered_stats``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscope.functions import bounded_broadcast, growing, round_half_even
from peerscope.operators.ordered import ordered_stats, quantiles_from_stats
from peerscope.session import materialize

# Metric lists, quantiles, thresholds and the model column order.
BENCH_METRICS = ["total_claim_count", "total_drug_cost", "cost_per_claim", "brand_share",
                 "opioid_share", "claims_per_bene", "cost_per_beneficiary"]
Z_METRICS = ["total_claim_count", "total_drug_cost", "cost_per_claim", "brand_share",
             "opioid_share", "claims_per_bene"]
PCT_METRICS = ["total_claim_count", "total_drug_cost", "cost_per_claim", "brand_share"]
BENCH_QUANTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}
BRAND_HEAVY_SHARE = 0.70
OPIOID_HEAVY_SHARE = 0.20
FLAG_COLUMNS = ["flag_high_volume", "flag_high_cost_per_claim", "flag_brand_heavy",
                "flag_concentrated_benes", "flag_opioid_heavy"]
FEATURE_COLUMNS = [
    "total_claim_count", "total_drug_cost", "total_beneficiaries",
    "cost_per_claim", "cost_per_beneficiary", "brand_share",
    "opioid_share", "claims_per_bene",
    "z_total_claim_count", "z_total_drug_cost", "z_cost_per_claim",
    "z_brand_share", "z_opioid_share", "z_claims_per_bene",
    "pct_total_claim_count", "pct_total_drug_cost",
    "pct_cost_per_claim", "pct_brand_share",
    "flag_high_volume", "flag_high_cost_per_claim",
    "flag_brand_heavy", "flag_concentrated_benes",
    "flag_opioid_heavy", "flag_count",
]
MAX_BROADCAST_GROUPS = 100_000


def long_metrics(df: DataFrame, metrics: list[str], keep: list[str]) -> DataFrame:
    """Unpivot ``metrics`` to rows ``(keep..., metric, x)`` (one scan for all metrics)."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("x")) for m in metrics])
    return df.select(*keep, F.inline(pairs))


def _peer_order_stats(providers: DataFrame, group: str, metrics: list[str]) -> DataFrame:
    long = long_metrics(providers.where(F.col(group).isNotNull()), metrics, [group])
    return ordered_stats(long, [group, "metric"], "x", ascending=True)


def specialty_benchmarks(providers: DataFrame, group: str = "specialty",
                         metrics: list[str] = BENCH_METRICS, order_stats: DataFrame | None = None) -> DataFrame:
    """A1: per group -- provider count, then mean, sample std, p50, p95, p99 of each
    metric over its non-null values (exact, linear interpolation).  NULL groups are
    left out."""
    peers = providers.where(F.col(group).isNotNull())
    moments = peers.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_providers"),
        *[e for m in metrics for e in (F.avg(m).alias(f"avg_{m}"), F.stddev_samp(m).alias(f"std_{m}"))])
    st = order_stats if order_stats is not None else _peer_order_stats(providers, group, metrics)
    qt = quantiles_from_stats(st, [group, "metric"], "x", BENCH_QUANTILES)
    wide = qt.groupBy(group).pivot("metric", metrics).agg(
        *[F.first(name).alias(name) for name in BENCH_QUANTILES])
    bench = moments.join(wide, on=group, how="left")
    cols = [group, "n_providers"]
    for m in metrics:
        cols += [F.col(f"avg_{m}"), F.col(f"std_{m}")]
        cols += [F.col(f"{m}_{name}").alias(f"{name}_{m}") for name in BENCH_QUANTILES]
    return bench.select(*cols)


def zscore(x: str, avg: str, std: str, digits: int = 3) -> Column:
    """(x - mean) / std with std 0 or undefined giving NULL, rounded half-even."""
    return round_half_even((F.col(x) - F.col(avg)) / F.nullif(F.col(std), F.lit(0.0)), digits)


def percentile_ranks(providers: DataFrame, order_stats: DataFrame, group: str = "specialty",
                     metrics: list[str] = PCT_METRICS, key: str | Sequence[str] = "npi", digits: int = 4) -> DataFrame:
    """Pandas ``rank(pct=True)`` inside the group (average rank of ties / non-null
    count), rounded.  Returns ``key`` (a column or several, such as npi and data_year) and
    one ``pct_<metric>`` column per metric.  The statistics hold one row per value, so the rows
    of a very common value may be split over tasks."""
    keys = key_columns(key)
    long = long_metrics(providers.where(F.col(group).isNotNull()), metrics, [*keys, group])
    st = order_stats.where(F.col("metric").isin(*metrics))
    ranked = long.join(growing(st), on=[group, "metric", "x"], how="inner")
    pct = (F.col("n_before") + (F.col("n") + F.lit(1)) / F.lit(2.0)) / F.col("n_total")
    return (ranked.select(*keys, "metric", round_half_even(pct, digits).alias("pct"))
            .groupBy(*keys).pivot("metric", metrics).agg(F.first("pct"))
            .select(*keys, *[F.col(m).alias(f"pct_{m}") for m in metrics]))


def add_flags(df: DataFrame, brand_share: float = BRAND_HEAVY_SHARE,
              opioid_share: float = OPIOID_HEAVY_SHARE) -> DataFrame:
    """Five binary signals (NULL comparisons count as 0) and their sum.
    Needs the benchmark columns ``p99_*`` / ``p95_claims_per_bene`` on the rows."""
    def flag(cond: Column) -> Column:
        return F.coalesce(cond, F.lit(False)).cast("int")
    df = df.withColumns({
        "flag_high_volume": flag(F.col("total_claim_count") > F.col("p99_total_claim_count")),
        "flag_high_cost_per_claim": flag(F.col("cost_per_claim") > F.col("p99_cost_per_claim")),
        "flag_brand_heavy": flag(F.col("brand_share") > F.lit(float(brand_share))),
        "flag_concentrated_benes": flag(F.col("claims_per_bene") > F.col("p95_claims_per_bene")),
        "flag_opioid_heavy": flag(F.col("opioid_share") > F.lit(float(opioid_share))),
    })
    total = F.col(FLAG_COLUMNS[0])
    for c in FLAG_COLUMNS[1:]:
        total = total + F.col(c)
    return df.withColumn("flag_count", total)


def key_columns(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def build_features(providers: DataFrame, group: str = "specialty",
                   key: str | Sequence[str] = "npi") -> tuple[DataFrame, DataFrame]:
    """Benchmarks and the provider frame with z_*, pct_*, flag_* columns added.
    ``key`` identifies a row: ``npi``, or ``("npi", "data_year")`` for several years.

    One order-statistics pass (all metrics unpivoted, grouped by
    ``(specialty, metric)``) feeds both the quantiles and the percentile ranks.
    """
    st = _peer_order_stats(providers, group, BENCH_METRICS)
    # one row per specialty: written once, then read by the join and by callers
    bench = materialize(specialty_benchmarks(providers, group, BENCH_METRICS, order_stats=st), "benchmarks")
    stats_cols = [group] + [f"{s}_{m}" for m in Z_METRICS for s in ("avg", "std")] + [
        "p99_total_claim_count", "p99_cost_per_claim", "p95_claims_per_bene"]
    small = bounded_broadcast(bench.select(*stats_cols), MAX_BROADCAST_GROUPS)
    joined = providers.join(small, on=group, how="left")
    joined = joined.withColumns({f"z_{m}": zscore(m, f"avg_{m}", f"std_{m}") for m in Z_METRICS})
    joined = add_flags(joined)
    joined = joined.drop(*[c for c in stats_cols if c != group])
    pct = percentile_ranks(providers, st, group, PCT_METRICS, key)
    feats = joined.join(growing(pct), on=key_columns(key), how="left")
    return bench, feats


def provider_features_table(features: DataFrame, key: str | Sequence[str] = "npi", group: str = "specialty") -> DataFrame:
    """Key, specialty and every ``z_*``, ``pct_*``, ``flag_*`` column."""
    cols = [c for c in features.columns if c.startswith(("z_", "pct_", "flag_"))]
    return features.select(*key_columns(key), group, *cols)


def model_matrix(features: DataFrame, key: str | Sequence[str] = "npi", group: str = "specialty",
                 label: str = "is_fraud_label", fill_nulls: bool = False) -> DataFrame:
    """Key, specialty, the 24 model features in fixed order (absent ones
    skipped) and the label; optionally NULL -> 0."""
    avail = [c for c in FEATURE_COLUMNS if c in features.columns]
    cols = [*key_columns(key), F.col(group).alias("specialty_description"), *avail]
    if label in features.columns:
        cols.append(label)
    out = features.select(*cols)
    return out.na.fill(0.0, subset=avail).na.fill(0, subset=avail) if fill_nulls else out
