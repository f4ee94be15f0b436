"""Column expressions shared by the operators.

Conventions
-----------
* Rounding is half-to-even on the scaled double (``rint(x * 10^d) / 10^d``),
  which is what NumPy/pandas ``round`` computes.  Spark's ``round`` rounds the
  decimal text half-up and would differ on ties.
* Money is summed as ``decimal(18,2)`` so totals do not depend on the order in
  which partitions are combined.
* Missing values are SQL NULL, never NaN.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c, digits: int = 0) -> Column:
    """``rint(c * 10^digits) / 10^digits`` (pandas ``Series.round``)."""
    c = _col(c)
    if digits == 0:
        return F.rint(c)
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def safe_ratio(num, den, digits: int | None = None) -> Column:
    """``num / den`` with a zero denominator giving NULL, optionally rounded."""
    r = _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0))
    return r if digits is None else round_half_even(r, digits)


def money_sum(c) -> Column:
    """Order-independent sum of a 2-decimal money column, returned as double."""
    return F.sum(_col(c).cast("decimal(18,2)")).cast("double")


def exact_mean(c, scale: int) -> Column:
    """Mean of a column whose values lie on a ``scale``-decimal grid (counts,
    money, rounded ratios): exact decimal sum / count.  Averages of such values
    often fall exactly on a rounding tie, where a floating sum in another order
    would round the other way."""
    c = _col(c)
    return F.sum(c.cast(f"decimal(18,{scale})")).cast("double") / F.count(c)


def try_number(c) -> Column:
    """Parse to double; unparsable text, NaN and infinite values become NULL (no ANSI error)."""
    v = _col(c).try_cast("double")
    return F.when(F.isnan(v) | (F.abs(v) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(v)


def strip_ws(c) -> Column:
    """Remove leading and trailing whitespace of any kind, Unicode blanks and the
    ASCII separators included (Python ``str.strip``)."""
    return F.regexp_replace(_col(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def title_case(c) -> Column:
    """Python ``str.title`` after stripping: a letter is upper-cased when it
    follows a non-letter (or starts the text), all other letters lower-cased."""
    tokens = F.regexp_extract_all(F.lower(strip_ws(c)), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    cap = F.transform(tokens, lambda t: F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1 << 30)))
    return F.when(_col(c).isNull(), F.lit(None).cast("string")).otherwise(F.array_join(cap, ""))


def stable_hash(c) -> Column:
    """Deterministic 32-bit hash from the md5 of the text, as a non-negative bigint.

    Equal in every engine that has md5, so sampling and fold assignment are
    reproducible and checkable."""
    return F.conv(F.substring(F.md5(_col(c).cast("string")), 1, 8), 16, 10).cast("bigint")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (SQL window partition semantics).

    The right side's key columns are dropped from the output."""
    if not keys:
        return left.crossJoin(right) if how == "inner" else left.join(right, how=how)
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = term if cond is None else (cond & term)
    out = left.join(renamed, cond, how)
    return out.drop(*[f"__r_{k}" for k in keys])


def growing(df: DataFrame) -> DataFrame:
    """Marks a join side whose rows grow with the input: the join is a shuffle join, whatever size the optimizer expects.
    It estimates Parquet files by their compressed bytes, so such a side would else be gathered by the driver and sent to
    every executor until its files are ten megabytes, which is many times that in memory."""
    return df.hint("merge")


def money_cents(c) -> Column:
    """A money column in whole cents (long), as its cast to ``decimal(18,2)`` rounds it.  Sums of longs are as exact as those of decimals
    and much cheaper; where ``c`` is the double nearest to whole cents no decimal is made at all."""
    x = _col(c).cast("double")
    near = F.rint(x * F.lit(100.0))
    exact = (near / F.lit(100.0) == x) & (F.abs(x) < F.lit(1e13))
    return F.when(exact, near.cast("long")).otherwise((_col(c).cast("decimal(18,2)") * F.lit(100)).cast("long"))


def bounded_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast-hint ``df`` only after checking it holds at most ``max_rows`` rows.

    The frame is persisted first so the size check and the join read the same
    computed rows; within the bound it stays cached (it is small).  Above the bound
    it is released and returned unhinted: the join is then a shuffle join (with
    AQE skew handling).  Meant for narrow rows (keys and statistics)."""
    kept = df.persist()
    if kept.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(kept)
    kept.unpersist()
    return df
