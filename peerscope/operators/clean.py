"""Cleaning and validation of raw prescriber rows (one row per provider)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from peerscope.functions import bounded_broadcast, safe_ratio, strip_ws, title_case, try_number
from peerscope.operators.ordered import exact_quantiles

# The column contract and defaults of the original cleaning step.
REQUIRED_COLUMNS = [
    "npi", "nppes_provider_state", "specialty_description",
    "total_claim_count", "total_drug_cost", "total_beneficiaries",
    "brand_claim_count", "generic_claim_count", "opioid_claim_count",
]
SUPPRESSED_COLUMNS = ["total_claim_count", "total_beneficiaries"]
NUMERIC_COLUMNS = ["total_claim_count", "total_drug_cost", "total_beneficiaries",
                   "brand_claim_count", "generic_claim_count", "opioid_claim_count",
                   "total_30_day_fill_count"]
COUNT_COLUMNS = [c for c in NUMERIC_COLUMNS if c != "total_drug_cost"]
NPI_PATTERN = r"^[12][0-9]{9}$"
MIN_REPORTED_COUNT = 11
OUTLIER_QUANTILE = 0.999
OUTLIER_MULTIPLIER = 20.0
PROVIDER_RENAMES = {
    "nppes_provider_last_org_name": "last_name",
    "nppes_provider_first_name": "first_name",
    "nppes_provider_state": "state",
    "specialty_description": "specialty",
}


def check_required_columns(df: DataFrame, required: list[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Raise when a required column is absent; return ``df`` unchanged."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def drop_suppressed(df: DataFrame, columns: list[str] = SUPPRESSED_COLUMNS,
                    min_count: int = MIN_REPORTED_COUNT) -> DataFrame:
    """C2+C3: keep rows whose counts parse as numbers and are at least ``min_count``
    (the publisher suppresses counts below 11 as ``*`` or blank)."""
    for c in columns:
        v = try_number(F.col(c))
        df = df.where(v.isNotNull() & (v >= F.lit(float(min_count))))
    return df


def valid_npi(df: DataFrame, pattern: str = NPI_PATTERN) -> DataFrame:
    """C4: strip whitespace, keep 10-digit identifiers starting with 1 or 2."""
    df = df.withColumn("npi", strip_ws(F.col("npi").cast("string")))
    return df.where(F.col("npi").rlike(pattern))


def cast_numeric(df: DataFrame, columns: list[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Unparsable and infinite numbers become 0; columns that are absent are skipped."""
    for c in columns:
        if c in df.columns:
            v = try_number(F.col(c))
            if c in COUNT_COLUMNS:      # a number beyond the long range counts as unparsable
                df = df.withColumn(c, F.coalesce(v.try_cast("long"), F.lit(0).cast("long")))
            else:
                df = df.withColumn(c, F.coalesce(v, F.lit(0.0)))
    return df


def drop_cost_outliers(df: DataFrame, group: str = "specialty_description", value: str = "total_drug_cost",
                       q: float = OUTLIER_QUANTILE, mult: float = OUTLIER_MULTIPLIER) -> DataFrame:
    """Drop rows whose cost exceeds ``mult`` x the exact ``q`` quantile of their
    group (rows of a NULL group are kept).  The quantile includes the row itself,
    so with the defaults the rule cannot fire in groups below ~952 rows."""
    qt = exact_quantiles(df.where(F.col(group).isNotNull()), [group], value, {"_q": q})
    # one row per specialty: broadcast behind a size check, so no provider row is shuffled on a hot specialty
    joined = df.join(bounded_broadcast(qt), on=group, how="left")
    keep = F.col("_q").isNull() | ~(F.col(value) > F.col("_q") * F.lit(float(mult)))
    return joined.where(keep).drop("_q")


def standardize_specialty(df: DataFrame, column: str = "specialty_description") -> DataFrame:
    """Strip + title-case the specialty name."""
    return df.withColumn(column, title_case(F.col(column)))


def add_ratios(df: DataFrame) -> DataFrame:
    """Five derived ratios; zero denominators give NULL."""
    return df.withColumns({
        "cost_per_claim": safe_ratio("total_drug_cost", "total_claim_count", 2),
        "cost_per_beneficiary": safe_ratio("total_drug_cost", "total_beneficiaries", 2),
        "brand_share": safe_ratio("brand_claim_count", "total_claim_count", 4),
        "opioid_share": safe_ratio("opioid_claim_count", "total_claim_count", 4),
        "claims_per_bene": safe_ratio("total_claim_count", "total_beneficiaries", 2),
    })


def clean_providers(raw: DataFrame, min_count: int = MIN_REPORTED_COUNT,
                    outlier_q: float = OUTLIER_QUANTILE, outlier_mult: float = OUTLIER_MULTIPLIER) -> DataFrame:
    """The whole cleaning step, in the original order: suppression, NPI, casts,
    outliers on the raw specialty, then name standardisation and ratios."""
    df = check_required_columns(raw)
    df = drop_suppressed(df, min_count=min_count)
    df = valid_npi(df)
    df = cast_numeric(df)
    df = drop_cost_outliers(df, q=outlier_q, mult=outlier_mult)
    df = standardize_specialty(df)
    return add_ratios(df)


#: Why the cleaning step drops a row, in the order of its checks; a row carries the first that applies.
REJECT_REASONS = ["claims_not_a_number", "claims_suppressed", "beneficiaries_not_a_number", "beneficiaries_suppressed",
                  "npi_missing", "npi_malformed", "cost_outlier"]


def mark_rejects(raw: DataFrame, min_count: int = MIN_REPORTED_COUNT, outlier_q: float = OUTLIER_QUANTILE,
                 outlier_mult: float = OUTLIER_MULTIPLIER) -> DataFrame:
    """All rows of ``raw``, untouched, with ``reject_reason`` (NULL: ``clean_providers`` keeps the row)."""
    df = check_required_columns(raw)
    claims, benes = (try_number(F.col(c)) for c in SUPPRESSED_COLUMNS)
    npi = strip_ws(F.col("npi").cast("string"))
    first = F.when(claims.isNull(), REJECT_REASONS[0]).when(claims < min_count, REJECT_REASONS[1])
    first = first.when(benes.isNull(), REJECT_REASONS[2]).when(benes < min_count, REJECT_REASONS[3])
    first = first.when(F.coalesce(npi, F.lit("")) == "", REJECT_REASONS[4]).when(~npi.rlike(NPI_PATTERN), REJECT_REASONS[5])
    df = df.withColumns({"reject_reason": first, "_cost": F.coalesce(try_number(F.col("total_drug_cost")), F.lit(0.0))})
    group = "specialty_description"
    qt = exact_quantiles(df.where(F.col("reject_reason").isNull() & F.col(group).isNotNull()).select(group, "_cost"), [group], "_cost", {"_q": outlier_q})
    joined = df.join(bounded_broadcast(qt), on=group, how="left")
    outlier = F.col("_cost") > F.col("_q") * F.lit(float(outlier_mult))
    return joined.withColumn("reject_reason", F.coalesce("reject_reason", F.when(outlier, REJECT_REASONS[6]))).select(*raw.columns, "reject_reason")


def clean_with_counts(raw: DataFrame, path: str, **rules) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """The cleaned rows, the rejected rows with their reason, and the counts of both, taken by ``observe`` while the marked rows
    are written to ``path``: no scan for counting.  Rows are written in the scan's own stage, which is never redone once
    its tasks have committed, so a lost executor does not count rows twice."""
    seen = Observation("cleaning")
    counts = [F.count_if(F.col("reject_reason") == r).alias(r) for r in REJECT_REASONS]
    marked = mark_rejects(raw, **rules).withColumn("kept", F.col("reject_reason").isNull())
    (marked.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.count_if("kept").alias("n_kept"), *counts)
     .write.mode("overwrite").partitionBy("kept").parquet(path))
    stored = raw.sparkSession.read.schema(marked.schema).parquet(path)
    kept = valid_npi(stored.where("kept").drop("kept", "reject_reason"))
    return add_ratios(standardize_specialty(cast_numeric(kept))), stored.where("NOT kept").drop("kept"), seen.get


def to_provider_table(clean: DataFrame, data_year: int | None = 2022) -> DataFrame:
    """Rename name/state/specialty columns and stamp the data year."""
    df = clean.withColumnsRenamed(PROVIDER_RENAMES)
    if data_year is not None and "data_year" not in df.columns:
        df = df.withColumn("data_year", F.lit(int(data_year)))
    return df
