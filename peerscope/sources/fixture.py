"""Provider roll-up from line-level claim facts.

The analysis works on one row per prescriber (and year), while the facts
arrive at line grain.  The driver's star schema stands in for that grain:

    lineitem (a claim line) -> orders (a beneficiary episode) -> customer (a prescriber)
    part.p_type classifies the drug, nation names the state, c_mktsegment the specialty.

Plan shape (scales with the line table, which is read once):
    1. lines JOIN part on partkey             (part is a dimension; AQE broadcasts it
                                              when its runtime size allows, else a
                                              skew-aware sort-merge join)
    2. lines dealt by order key, once: GROUP BY (order key, service year) and
       JOIN orders both use that partitioning
    3. GROUP BY customer, year                (one row per episode => distinct
                                              beneficiaries need no COUNT(DISTINCT);
                                              partial aggregation absorbs hot customers)
       -> materialised facts, shared by both roll-ups
    4. GROUP BY customer                      (only for the roll-up over all years)
    5. JOIN customer, nation                  (nation: 25 fixed rows, broadcast)
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peerscope.functions import growing, money_cents
from peerscope.sources.files import read_table

# Fixed values of the fixture mapping (see FIXTURES.md B).
BRAND_TYPES = ("LARGE", "MEDIUM", "STANDARD", "ECONOMY")
OPIOID_TYPE = "SMALL"
FILL_STATUS = "F"
EXCLUSION_PRIORITY = "1-URGENT"


def npi_of(custkey) -> F.Column:
    """'1' followed by the zero-padded 9-digit customer key."""
    return F.concat(F.lit("1"), F.lpad(F.col(custkey).cast("string"), 9, "0"))


def order_year_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (episode, service year): claim lines, money and drug-class counts,
    with the prescriber key.  The one pass over the line table; money is in cents.

    ``first`` marks one row of each episode and ``first_opioid`` the same row where any year of the
    episode has an opioid line, so the roll-up over all years counts an episode once
    without grouping the facts by episode again (the window uses the join's partitioning)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_linestatus", "l_shipdate")
    is_brand = F.col("p_type").isin(*BRAND_TYPES).cast("long")
    is_opioid = (F.col("p_type") == OPIOID_TYPE).cast("long")
    is_fill = (F.col("l_linestatus") == FILL_STATUS).cast("long")
    # the classes are told on the part table, which has far fewer rows than the lines
    part = read_table(spark, sf_dir, "part").select("p_partkey", is_brand.alias("is_brand"), is_opioid.alias("is_opioid"))
    lines = li.join(part, li.l_partkey == part.p_partkey, "inner").where("l_orderkey IS NOT NULL").select(
        "l_orderkey", F.year("l_shipdate").alias("data_year"), money_cents("l_extendedprice").alias("cents"),
        "is_brand", "is_opioid", is_fill.alias("is_fill"))
    # lines of an order are few and lie apart, so adding them up before the shuffle saves next to nothing; dealt by the order
    # alone, the grouping, the join and the window below need no further shuffle
    per_order_year = lines.repartition("l_orderkey").groupBy("l_orderkey", "data_year").agg(
        F.count(F.lit(1)).alias("claims"),
        F.sum("cents").alias("cents"),
        F.sum("is_brand").alias("brand"),
        F.sum("is_opioid").alias("opioid"),
        F.sum("is_fill").alias("fills"),
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    facts = per_order_year.join(growing(orders), per_order_year.l_orderkey == orders.o_orderkey, "inner").drop("o_orderkey")
    episode = Window.partitionBy("l_orderkey")      # the years of one episode
    first = (F.row_number().over(episode.orderBy("data_year")) == 1).cast("long")
    return facts.withColumns({"first": first, "first_opioid": first * (F.sum("opioid").over(episode) > 0).cast("long")})


def customer_year_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (customer, service year): sums of the episode facts, which both roll-ups (per provider and per provider-year) share.
    ``episodes`` and ``opioid_episodes`` count within the year; ``first`` and ``first_opioid`` count an episode of several years once."""
    return order_year_facts(spark, sf_dir).groupBy("o_custkey", "data_year").agg(
        *[F.sum(c).alias(c) for c in ("claims", "cents", "brand", "opioid", "fills", "first", "first_opioid")],
        F.count(F.lit(1)).alias("episodes"), F.count_if(F.col("opioid") > 0).alias("opioid_episodes"))


def _rollup(spark: SparkSession, sf_dir: str, by_year: bool, facts: DataFrame | None = None) -> DataFrame:
    facts = facts if facts is not None else customer_year_facts(spark, sf_dir)
    # an episode spanning two years is still one beneficiary episode
    episodes, opioid_episodes = ("episodes", "opioid_episodes") if by_year else ("first", "first_opioid")
    sums = {"total_claim_count": "claims", "cents": "cents", "total_beneficiaries": episodes, "brand_claim_count": "brand",
            "opioid_claim_count": "opioid", "opioid_bene_count": opioid_episodes, "total_30_day_fill_count": "fills"}
    if by_year:
        per_cust = facts.select("o_custkey", "data_year", *[F.col(c).alias(name) for name, c in sums.items()])
    else:
        per_cust = facts.groupBy("o_custkey").agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    # the exact decimal's nearest double
    cost = (F.col("cents").cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("double")
    per_cust = per_cust.withColumn("total_drug_cost", cost).drop("cents")
    cust = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    out = (per_cust.join(growing(cust), per_cust.o_custkey == cust.c_custkey, "inner")
           # nation is a fixed 25-row dimension: a proven bound for broadcasting
           .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "inner"))
    cols = [
        npi_of("c_custkey").alias("npi"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("nppes_provider_last_org_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("nppes_provider_first_name"),
        F.col("n_name").alias("nppes_provider_state"),
        F.col("c_mktsegment").alias("specialty_description"),
        "total_claim_count",
        "total_30_day_fill_count",
        "total_drug_cost",
        "total_beneficiaries",
        "brand_claim_count",
        (F.col("total_claim_count") - F.col("brand_claim_count")).alias("generic_claim_count"),
        "opioid_claim_count",
        "opioid_bene_count",
        (F.col("c_acctbal") < 0).cast("int").alias("is_fraud_label"),
    ]
    if by_year:
        cols.append(F.col("data_year").cast("int").alias("data_year"))
    return out.select(*cols)


def providers_raw(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> DataFrame:
    """One row per prescriber with the raw Part D style columns (before cleaning)."""
    return _rollup(spark, sf_dir, by_year=False, facts=facts)


def provider_years_raw(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> DataFrame:
    """One row per prescriber and service year (multi-year source for velocity queries)."""
    return _rollup(spark, sf_dir, by_year=True, facts=facts)


def exclusions_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exclusion list: (npi, exclusion_date) for prescribers with a negative
    balance on their urgent episodes.  Several dates per npi exercise fan-out."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    j = (orders.where(F.col("o_orderpriority") == EXCLUSION_PRIORITY)
         .join(growing(cust.where(F.col("c_acctbal") < 0)), F.col("o_custkey") == F.col("c_custkey"), "inner"))
    return (j.select(npi_of("c_custkey").alias("npi"),
                     F.to_date("o_orderdate").alias("exclusion_date"))
            .distinct()
            .select("npi", "exclusion_date",
                    F.lit(None).cast("date").alias("reinstatement_date"),
                    F.lit(None).cast("string").alias("exclusion_type"),
                    F.lit(None).cast("string").alias("general")))
