"""Order statistics within groups without a one-task window.

``Window.partitionBy(g).orderBy(x)`` sends every row of a group to one task.
Peer groups are few and uneven (a specialty or a state may hold a third of
all providers; the precision-recall curve has no group at all), so ranks,
percentile ranks, exact quantiles and running sums are computed here as:

1. aggregate to distinct ``(keys, value)`` with row count and measure sums
   (map-side combine, ties collapse);
2. ``repartitionByRange`` on ``(keys, value)`` -- a hot group is spread over
   many tasks, each holding a contiguous run of the order;
3. checkpoint, so partition ids stay attached to the same rows;
4. running sums inside each ``(partition, keys)`` run, plus block totals;
5. block offsets = running sum of earlier blocks' totals (a table with about
   one row per partition and group), joined back.

The result has, per distinct ``(keys, value)``: ``n`` rows with that value,
``n_before`` rows earlier in the order, ``n_total`` rows in the group, and the
same triple for every measure.  Everything derived below is exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerscope.functions import join_null_safe
from peerscope.session import materialize


def ordered_stats(df: DataFrame, keys: Sequence[str], value: str, ascending: bool = True,
                  measures: Mapping[str, Column] | None = None,
                  num_partitions: int | None = None) -> DataFrame:
    """Per distinct ``(keys, value)``: counts and measure sums before / at / in total.

    Rows with NULL ``value`` are ignored.  Output columns: ``keys``, ``value``,
    ``n``, ``n_before``, ``n_total`` and, for each measure ``m``, ``m``,
    ``m_before``, ``m_total``.
    """
    keys = list(keys)
    measures = dict(measures or {})
    order_col = F.col(value).asc() if ascending else F.col(value).desc()

    base = (df.where(F.col(value).isNotNull())
            .groupBy(*keys, value)
            .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(m) for m, c in measures.items()]))
    # without an explicit count AQE sizes the range partitions from the data
    # (coalescing merges neighbours, so each partition stays a contiguous run)
    order_by = [*[F.col(k).asc() for k in keys], order_col]
    repart = (base.repartitionByRange(num_partitions, *order_by) if num_partitions
              else base.repartitionByRange(*order_by))
    ranged = materialize(repart.withColumn("_pid", F.spark_partition_id()))

    cols = ["n", *measures]
    w_local = (Window.partitionBy("_pid", *keys).orderBy(order_col)
               .rowsBetween(Window.unboundedPreceding, -1))
    local = ranged.select(
        *keys, value, "_pid", *cols,
        *[F.coalesce(F.sum(c).over(w_local), F.lit(0)).alias(f"_loc_{c}") for c in cols])

    blocks = ranged.groupBy("_pid", *keys).agg(*[F.sum(c).alias(f"_blk_{c}") for c in cols])
    w_prev = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0)))
    w_off = w_prev.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    offsets = blocks.select(
        "_pid", *keys,
        *[F.coalesce(F.sum(f"_blk_{c}").over(w_off), F.lit(0)).alias(f"_off_{c}") for c in cols],
        *[F.sum(f"_blk_{c}").over(w_all).alias(f"{c}_total") for c in cols])

    joined = join_null_safe(local, offsets, ["_pid", *keys])
    out = [*keys, value]
    for c in cols:
        out += [F.col(c), (F.col(f"_off_{c}") + F.col(f"_loc_{c}")).alias(f"{c}_before"), F.col(f"{c}_total")]
    return joined.select(*out)


def with_order_stats(df: DataFrame, keys: Sequence[str], value: str, ascending: bool = True,
                     measures: Mapping[str, Column] | None = None) -> DataFrame:
    """Attach ``n``, ``n_before``, ``n_total`` (and measure triples) to every row of ``df``."""
    stats = ordered_stats(df, keys, value, ascending, measures).withColumnRenamed("n", "_ties")
    for m in (measures or {}):
        stats = stats.withColumnRenamed(m, f"_grp_{m}")
    return join_null_safe(df, stats, [*keys, value], how="left")


def sql_rank(n_before: str = "n_before") -> Column:
    """SQL ``RANK()``: 1 + rows strictly earlier in the order."""
    return F.col(n_before) + F.lit(1)


def average_rank_pct(n_before: str = "n_before", ties: str = "_ties", total: str = "n_total") -> Column:
    """pandas ``rank(pct=True)``: average 1-based rank of the tie block / non-null count."""
    return (F.col(n_before) + (F.col(ties) + F.lit(1)) / F.lit(2.0)) / F.col(total)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    probs: Mapping[str, float]) -> DataFrame:
    """Exact linear-interpolation quantiles per group (pandas ``quantile``,
    SQL ``percentile_cont``), from the distributed order statistics.

    For probability ``q`` and ``N`` non-null values the position is
    ``(N - 1) * q``; the two neighbouring order statistics are found by the
    rows whose ``[n_before, n_before + n)`` interval contains them, and the
    result is ``lo + (hi - lo) * (pos - floor(pos))``.
    """
    return quantiles_from_stats(ordered_stats(df, keys, value, ascending=True), keys, value, probs)


def quantiles_from_stats(st: DataFrame, keys: Sequence[str], value: str,
                         probs: Mapping[str, float]) -> DataFrame:
    """Quantiles from an ascending ``ordered_stats`` result (see ``exact_quantiles``)."""
    keys = list(keys)
    sel = [*keys]
    aggs = []
    for name, q in probs.items():
        pos = (F.col("n_total") - F.lit(1)).cast("double") * F.lit(float(q))
        lo = F.floor(pos)
        hi = F.ceil(pos)
        has_lo = (F.col("n_before") <= lo) & (lo < F.col("n_before") + F.col("n"))
        has_hi = (F.col("n_before") <= hi) & (hi < F.col("n_before") + F.col("n"))
        aggs += [F.max(F.when(has_lo, F.col(value))).alias(f"_lo_{name}"),
                 F.max(F.when(has_hi, F.col(value))).alias(f"_hi_{name}"),
                 F.max(pos - lo).alias(f"_fr_{name}")]
    g = st.groupBy(*keys).agg(*aggs)
    for name in probs:
        lo_v, hi_v, fr = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), F.col(f"_fr_{name}")
        sel.append(F.when(lo_v == hi_v, lo_v).otherwise(lo_v + (hi_v - lo_v) * fr).alias(name))
    return g.select(*sel)
