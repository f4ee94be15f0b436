"""Mergeable peer statistics: states of one year that add up over years, so that a new year does not reread the old ones.

- Moments (count, mean, sum of squared deviations) per group, year and metric merge and subtract exactly up to rounding;
  ``benchmarks_from_states`` gives the mean and sample deviation of ``specialty_benchmarks``.
- KLL sketches give quantiles within a rank error that follows from ``k``; HLL sketches give distinct counts.

Plan: one scan of the rows with map-side aggregation on (group, year, metric); a state is a few numbers or a sketch whose size
its parameter bounds.  Merging reads states only: one row per group, year and metric, however many rows were behind it.

Edge cases: rows of a NULL group or year are left out; a metric without any non-null value has count 0 and NULL mean and
deviation (NULL sketch quantiles); one value has mean but no deviation; NaN counts as missing; no rows give no states.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.operators.peers import BENCH_METRICS, BENCH_QUANTILES, long_metrics
from peerscope.sources.files import overwrite_partitions

YEAR = "data_year"
KLL_K = 1024
HLL_LG_K = 12


def _values(rows: DataFrame, group: str, metrics: Sequence[str], year: str) -> DataFrame:
    kept = rows.where(F.col(group).isNotNull() & F.col(year).isNotNull())
    return long_metrics(kept, list(metrics), [group, year]).withColumn("x", F.nanvl("x", F.lit(None)))


# -- moments --------------------------------------------------------------------------------------------------------------------

def moment_states(rows: DataFrame, group: str = "specialty", metrics: Sequence[str] = BENCH_METRICS, year: str = YEAR) -> DataFrame:
    """Per (group, year, metric): ``n_rows``, and ``n``, ``mean``, ``m2`` of the non-null values."""
    return _values(rows, group, metrics, year).groupBy(group, year, "metric").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("x").alias("n"), F.avg("x").alias("mean"),
        (F.var_pop("x") * F.count("x")).alias("m2"))


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of coarser ``keys`` (those without the year, say).  Squared deviations are moved to the common mean, which
    is found first, so no large squares are subtracted."""
    keys = list(keys)
    total = states.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        (F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("_mean"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    shift = F.col("mean") - F.col("_mean")
    return states.join(total, same).groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.max("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * shift * shift).alias("m2"))


def subtract_states(total: DataFrame, part: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The states of the rows of ``total`` that are not in ``part`` (a withdrawn year); groups left without rows go."""
    p = part.select(*keys, *[F.col(c).alias(f"_{c}") for c in ("n_rows", "n", "mean", "m2")])
    joined = total.join(p, list(keys), "left").na.fill(0, ["_n_rows", "_n"]).na.fill(0.0, ["_mean", "_m2"])
    n = F.col("n") - F.col("_n")
    mean = (F.col("n") * F.col("mean") - F.col("_n") * F.col("_mean")) / F.nullif(n, F.lit(0))
    gap = mean - F.col("_mean")
    m2 = F.greatest(F.col("m2") - F.col("_m2") - n * F.col("_n") / F.col("n") * gap * gap, F.lit(0.0))
    left = joined.select(*keys, (F.col("n_rows") - F.col("_n_rows")).alias("n_rows"), n.alias("n"), mean.alias("mean"),
                         F.when(n > 0, m2).alias("m2"))
    return left.where("n_rows > 0")


def benchmarks_from_states(states: DataFrame, keys: Sequence[str] = ("specialty", "metric")) -> DataFrame:
    """Counts, mean and sample deviation (NULL below two values)."""
    return states.select(*keys, "n_rows", "n", F.col("mean").alias("avg"),
                         F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("std"))


class BenchmarkStore:
    """Moment states on disk, one partition a year.  ``put`` replaces the years of its rows and reads nothing else;
    ``benchmarks`` merges states, of all years or of some."""

    def __init__(self, spark: SparkSession, path: str, group: str = "specialty", metrics: Sequence[str] = BENCH_METRICS):
        self.spark, self.path, self.group, self.metrics = spark, path, group, list(metrics)

    def put(self, rows: DataFrame) -> None:
        overwrite_partitions(moment_states(rows, self.group, self.metrics), self.path, [YEAR])

    def states(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def benchmarks(self, years: Sequence[int] | None = None, without: int | None = None) -> DataFrame:
        """Of ``years`` (default: all), or of all but one year, by subtraction from the whole."""
        keys = [self.group, "metric"]
        own = self.states() if years is None else self.states().where(F.col(YEAR).isin(list(years)))
        merged = merge_states(own, keys)
        if without is not None:
            merged = subtract_states(merged, self.states().where(F.col(YEAR) == without), keys)
        return benchmarks_from_states(merged, keys)


# -- sketches -------------------------------------------------------------------------------------------------------------------

def kll_rank_error(k: int = KLL_K) -> float:
    """Rank error, as a share of the rows, that a single quantile of a KLL sketch keeps with 99 % confidence."""
    return 2.296 / k ** 0.9723


def quantile_sketches(rows: DataFrame, group: str = "specialty", metrics: Sequence[str] = BENCH_METRICS, year: str = YEAR,
                      k: int = KLL_K) -> DataFrame:
    """Per (group, year, metric): a KLL sketch of the non-null values and their number."""
    return (_values(rows, group, metrics, year).where(F.col("x").isNotNull()).groupBy(group, year, "metric")
            .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("x", F.lit(k)).alias("sketch")))


def merge_quantile_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One sketch for each of ``keys``.  A group's list holds one bounded sketch a year, never rows."""
    parts = F.collect_list("sketch")
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), parts.alias("_parts")).select(
        *keys, "n", F.reduce(F.slice("_parts", F.lit(2), F.size("_parts")), F.get("_parts", F.lit(0)), F.kll_sketch_merge_double).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, keys: Sequence[str], quantiles: Mapping[str, float] = BENCH_QUANTILES) -> DataFrame:
    """Long form: ``keys``, ``n``, the quantile's name, its share ``q`` and the ``value`` (one of the values)."""
    pairs = F.array(*[F.struct(F.lit(name).alias("quantile"), F.lit(float(q)).alias("q"),
                               F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias("value")) for name, q in quantiles.items()])
    return sketches.select(*keys, "n", F.inline(pairs))


def sketch_rank_checks(rows: DataFrame, found: DataFrame, group: str = "specialty", metrics: Sequence[str] = BENCH_METRICS,
                       year: str = YEAR, tolerance: float | None = None) -> DataFrame:
    """Holds sketch quantiles against all rows: the shares of values below and up to ``value`` must enclose ``q`` within
    ``tolerance`` (default: twice the 99 % error, plus one row)."""
    tol = 2 * kll_rank_error() if tolerance is None else tolerance
    keys = [group, "metric"]
    counted = (_values(rows, group, metrics, year).where(F.col("x").isNotNull())
               .groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("c"))
               .join(F.broadcast(found) if found.count() <= 100_000 else found, keys)
               .groupBy(*keys, "quantile", "q", "n")
               .agg(F.coalesce(F.sum(F.when(F.col("x") < F.col("value"), F.col("c"))), F.lit(0)).alias("below"),
                    F.coalesce(F.sum(F.when(F.col("x") <= F.col("value"), F.col("c"))), F.lit(0)).alias("up_to")))

    def within(rank: Column, sign: int) -> Column:
        slack = F.lit(tol) * F.col("n") + 1
        return rank <= F.col("q") * F.col("n") + slack if sign > 0 else rank >= F.col("q") * F.col("n") - slack

    return counted.select(*keys, "quantile", "n", (within(F.col("below"), 1) & within(F.col("up_to"), -1)).alias("within"))


def distinct_sketches(rows: DataFrame, key: str = "npi", group: str = "specialty", year: str = YEAR, lg_k: int = HLL_LG_K) -> DataFrame:
    """Per (group, year): an HLL sketch of the distinct keys."""
    kept = rows.where(F.col(group).isNotNull() & F.col(year).isNotNull())
    return kept.groupBy(group, year).agg(F.hll_sketch_agg(key, F.lit(lg_k)).alias("sketch"))


def distinct_counts(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Estimated distinct keys of the united sketches."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_estimated"))


def hll_error(lg_k: int = HLL_LG_K) -> float:
    """Relative standard error of a united sketch."""
    return 1.04 / 2 ** (lg_k / 2)
