"""File sources and sinks with explicit schemas (no inference)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw prescriber file: every column is read as text so that suppressed
# counts ("*"), blanks and stray text survive until cleaning decides.
PROVIDERS_RAW_SCHEMA = T.StructType([
    T.StructField("npi", T.StringType()),
    T.StructField("nppes_provider_last_org_name", T.StringType()),
    T.StructField("nppes_provider_first_name", T.StringType()),
    T.StructField("nppes_provider_state", T.StringType()),
    T.StructField("specialty_description", T.StringType()),
    T.StructField("total_claim_count", T.StringType()),
    T.StructField("total_30_day_fill_count", T.StringType()),
    T.StructField("total_drug_cost", T.StringType()),
    T.StructField("total_beneficiaries", T.StringType()),
    T.StructField("brand_claim_count", T.StringType()),
    T.StructField("generic_claim_count", T.StringType()),
    T.StructField("opioid_claim_count", T.StringType()),
    T.StructField("opioid_bene_count", T.StringType()),
    T.StructField("is_fraud_label", T.StringType()),
])

EXCLUSIONS_RAW_SCHEMA = T.StructType([
    T.StructField("npi", T.StringType()),
    T.StructField("exclusion_date", T.StringType()),
    T.StructField("reinstatement_date", T.StringType()),
    T.StructField("exclusion_type", T.StringType()),
    T.StructField("general", T.StringType()),
])


#: What cleaning needs (C1); the other columns of the schema are optional.
PROVIDERS_REQUIRED = ["npi", "nppes_provider_state", "specialty_description", "total_claim_count", "total_drug_cost",
                      "total_beneficiaries", "brand_claim_count", "generic_claim_count", "opioid_claim_count"]
#: Header names of the public exclusion list.
EXCLUSION_HEADERS = {"EXCLDATE": "exclusion_date", "REINDATE": "reinstatement_date", "EXCLTYPE": "exclusion_type"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table ``<sf_dir>/<name>.parquet`` (filters and projections push down)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv_by_name(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = (),
                     mapping: Mapping[str, str] | None = None, **options) -> DataFrame:
    """Header CSV as text columns, selected by header name.

    Header names match without regard to case and outer blanks; ``mapping`` renames header names to schema
    names.  Columns in another order or extra ones do no harm, a missing required column is an error,
    a missing optional one is NULL.  Every column is read as text (no inference)."""
    raw = spark.read.options(header=True, inferSchema=False, mode="PERMISSIVE", **options).csv(path)
    rename = {k.strip().lower(): v.lower() for k, v in (mapping or {}).items()}
    by_name: dict[str, str] = {}
    for c in raw.columns:
        name = c.strip().lstrip("\ufeff").lower()
        by_name.setdefault(rename.get(name, name), c)
    missing = [c for c in required if c.lower() not in by_name]
    if missing:
        raise ValueError(f"missing required columns: {missing} in {path}")
    quoted = {k: "`" + v.replace("`", "``") + "`" for k, v in by_name.items()}
    return raw.select(*[(F.col(quoted[f.name.lower()]) if f.name.lower() in quoted else F.lit(None)).cast(f.dataType).alias(f.name)
                        for f in schema.fields])


def read_providers_csv(spark: SparkSession, path: str, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Header CSV of raw prescriber rows, by column name; npi stays text (leading zeros kept)."""
    return read_csv_by_name(spark, path, PROVIDERS_RAW_SCHEMA, PROVIDERS_REQUIRED, mapping)


def read_exclusions_csv(spark: SparkSession, path: str, date_format: str = "yyyyMMdd",
                        mapping: Mapping[str, str] = EXCLUSION_HEADERS) -> DataFrame:
    """Exclusion list in Latin-1, by column name, with ``yyyyMMdd`` dates; unparsable dates become NULL."""
    raw = read_csv_by_name(spark, path, EXCLUSIONS_RAW_SCHEMA, ["npi"], mapping, encoding="ISO-8859-1")
    return raw.select(
        F.trim("npi").alias("npi"),
        F.try_to_date("exclusion_date", date_format).alias("exclusion_date"),
        F.try_to_date("reinstatement_date", date_format).alias("reinstatement_date"),
        "exclusion_type", "general")


def read_multi_year(spark: SparkSession, paths_by_year: Mapping[int, str], fmt: str = "parquet") -> DataFrame:
    """Union of yearly files with a ``data_year`` column (partition column on write)."""
    frames = []
    for year, path in sorted(paths_by_year.items()):
        df = (read_providers_csv(spark, path) if fmt == "csv" else spark.read.parquet(path))
        frames.append(df.withColumn("data_year", F.lit(int(year))))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def profile_source(df: DataFrame, required: list[str], sample_rows: int = 5) -> DataFrame:
    """Source check: one row with column count, missing required columns, row count
    and the first rows rendered as JSON (the download validation report)."""
    missing = [c for c in required if c not in df.columns]
    sample = df.limit(sample_rows).select(F.to_json(F.struct(*df.columns)).alias("j"))
    return (df.agg(F.count(F.lit(1)).alias("n_rows"))
            .crossJoin(sample.agg(F.collect_list("j").alias("sample_rows")))
            .select(F.lit(len(df.columns)).alias("n_columns"),
                    F.array(*[F.lit(c) for c in missing]).cast("array<string>").alias("missing_columns"),
                    F.lit(not missing).alias("columns_ok"),
                    "n_rows", "sample_rows"))


def profile_path(spark: SparkSession, path: str, required: list[str], fmt: str = "csv") -> DataFrame:
    """S13 for a file or folder that may not exist: ``exists_flag`` and ``size_bytes`` (listed by Spark, so
    any file system), then the columns of ``profile_source`` (NULL without a source)."""
    try:
        size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    except Exception as exc:  # noqa: BLE001 - missing path
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        size = None
    if size is None:
        empty = profile_source(spark.createDataFrame([], "c string"), required)
        return spark.range(1).select(F.lit(False).alias("exists_flag"), F.lit(0).cast("long").alias("size_bytes"),
                                     *[F.lit(None).cast(f.dataType).alias(f.name) for f in empty.schema.fields])
    df = spark.read.options(header=True, inferSchema=False).csv(path) if fmt == "csv" else spark.read.format(fmt).load(path)
    return profile_source(df, required).select(F.lit(True).alias("exists_flag"), F.lit(int(size)).cast("long").alias("size_bytes"), "*")


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Overwrite an output table (optionally partitioned, e.g. by ``data_year``)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet") -> None:
    """Replace only the partitions that ``df`` has rows of (a year, say); the others stay, and a repeated
    write leaves the same table."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).format(fmt).save(path))


MANIFEST = "_manifest"


def write_years(df: DataFrame, path: str, run: int, year: str = "data_year") -> None:
    """The yearly output table with a record of what each run wrote.  Years of ``df`` are replaced, others
    stay; ``run`` numbers the refresh, and a run written twice replaces its own record.  The rows of a year are counted by one
    narrow scan of the written table, not of the input again."""
    if df.where(F.col(year).isNull()).limit(1).count():
        raise ValueError(f"rows without {year} cannot be placed")
    spark = df.sparkSession
    columns = [c for c in df.columns if c != year]
    overwrite_partitions(df.select(*columns, year).withColumn("run", F.lit(int(run))), path, [year])
    written = spark.read.parquet(path).where(F.col("run") == int(run)).groupBy(year).agg(F.count(F.lit(1)).alias("n_rows"))
    overwrite_partitions(written.withColumn("run", F.lit(int(run))), f"{path.rstrip('/')}{MANIFEST}", ["run"])


def read_years(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("run")


def read_manifest(spark: SparkSession, path: str, year: str = "data_year") -> DataFrame:
    """The run that wrote each year last, and its rows."""
    last = spark.read.parquet(f"{path.rstrip('/')}{MANIFEST}").groupBy(year).agg(F.max_by(F.struct("run", "n_rows"), "run").alias("m"))
    return last.select(year, F.col("m.run").alias("run"), F.col("m.n_rows").alias("n_rows"))


def write_json_metrics(df: DataFrame, path: str) -> None:
    """Metrics sink: a one-row frame written as a single JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_optional(spark: SparkSession, path_or_table: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """S3: a table or folder that may not exist yet (e.g. scores before the first
    model run) -- the data when present, else an empty frame with ``schema``."""
    if spark.catalog.tableExists(path_or_table) if "/" not in path_or_table else False:
        return spark.table(path_or_table)
    try:
        return spark.read.format(fmt).schema(schema).load(path_or_table)
    except Exception as exc:  # noqa: BLE001 - missing path
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return spark.createDataFrame([], schema)
        raise
