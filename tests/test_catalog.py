from peerscope.operators import catalog as K
from peerscope.operators import reports as R


def test_yoy_uses_previous_available_year(spark):
    years = spark.createDataFrame(
        [("1", "A", 2020, 10), ("1", "A", 2022, 35),    # gap: lag takes 2020, growth 2.5
         ("2", "A", 2020, 0), ("2", "A", 2021, 50),     # prior 0 -> NULL growth, not returned
         ("3", "A", 2021, 10), ("3", "A", 2022, 30)],   # exactly +200 % -> not > 2.0
        "npi string, specialty string, data_year int, total_claim_count long")
    out = K.yoy_velocity(years).collect()
    assert [(r.npi, r.data_year, r.prior_year_claims, r.yoy_growth_pct) for r in out] == [("1", 2022, 10, 250.0)]
    assert {r.npi for r in K.yoy_surge(years).collect()} == {"1", "3"}


def test_oig_dedupe_vs_fanout(spark):
    prov = spark.createDataFrame([("1", "CRITICAL"), ("2", "LOW")], "npi string, fraud_tier string")
    ex = spark.createDataFrame([("1", "2020-01-01"), ("1", "2021-01-01")], "npi string, exclusion_date string")
    d = {r.fraud_tier: (r.total_in_tier, r.oig_confirmed) for r in K.oig_by_tier(prov, ex).collect()}
    f = {r.fraud_tier: (r.total_in_tier, r.oig_confirmed) for r in K.oig_by_tier(prov, ex, dedupe=False).collect()}
    assert d == {"CRITICAL": (1, 1), "LOW": (1, 0)}
    assert f == {"CRITICAL": (2, 2), "LOW": (1, 0)}


def _providers(spark, n=40):
    rows = []
    for i in range(n):
        claims = 600 if i == 0 else 100 + (i % 7)
        rows.append((f"1{i:09d}", "F", f"L{i}", "AZ" if i % 2 else "TX", "Spec", claims, claims * 10.0, 10.0,
                     0.8 if i < 3 else 0.2, 0.25 if i < 5 else 0.05, 3.0 + i, 20, "CRITICAL" if i < 4 else "LOW",
                     0.9 - i / 100, 0, 5))
    return spark.createDataFrame(rows, "npi string, first_name string, last_name string, state string, "
                                 "specialty string, total_claim_count long, total_drug_cost double, "
                                 "cost_per_claim double, brand_share double, opioid_share double, "
                                 "claims_per_bene double, total_beneficiaries long, fraud_tier string, "
                                 "fraud_score_ensemble double, is_fraud_label int, opioid_claim_count long")


def test_catalog_defaults(spark):
    p = _providers(spark)
    f1 = K.peer_outliers(p).collect()                       # default z > 3.0
    assert [r.npi for r in f1] == ["1000000000"] and f1[0].provider_name == "F L0"
    f2 = K.brand_heavy(p).collect()                         # share > .75 and claims > 500
    assert [r.npi for r in f2] == ["1000000000"]
    f3 = K.concentrated_beneficiaries(p).collect()          # claims > 200
    assert [(r.npi, r.rank_within_specialty) for r in f3] == [("1000000000", 1)]
    f5 = K.opioid_by_state(p).collect()                     # claims > 100, share > .20
    assert sorted((r.state, r.state_opioid_rank) for r in f5) == [("AZ", 1), ("AZ", 1), ("TX", 1), ("TX", 1),
                                                                  ("TX", 1)]
    i4 = {r.state: r.critical_count for r in K.geographic_clustering(p).collect()}
    assert i4 == {"AZ": 2, "TX": 2}


def test_rank_ties_share_and_gap(spark):
    df = spark.createDataFrame([("1", "A", 3.0), ("2", "A", 3.0), ("3", "A", 1.0), ("4", "B", 2.0)],
                               "npi string, g string, v double")
    out = {r.npi: r.rk for r in K._rank_desc(df, ["g"], "v", "rk").collect()}
    assert out == {"1": 1, "2": 1, "3": 3, "4": 1}


def test_state_table_and_fixed_tier_rows(spark):
    p = _providers(spark)
    st = R.state_table(p).collect()
    assert [r.rank for r in st] == [1, 2] and st[0].state in {"AZ", "TX"}
    tiers = [r.fraud_tier for r in R.tier_distribution(p).collect()]
    assert tiers == ["CRITICAL", "HIGH", "MODERATE", "LOW"]
    assert R.pattern_table(p.where("fraud_tier = 'LOW'")).count() == 0


def test_lookup_trims_and_defaults(spark):
    p = _providers(spark).withColumn("flag_count", R.F.lit(None).cast("int"))
    r = R.lookup(p, " 1000000003 ").collect()
    assert len(r) == 1 and r[0].flag_count == 0
    assert R.lookup(p, "999").count() == 0
