from pyspark.sql import functions as F

from peerscope.operators import peers as P
from peerscope.operators import scoring as S

COLS = ("npi string, specialty string, total_claim_count long, total_drug_cost double, cost_per_claim double, "
        "brand_share double, opioid_share double, claims_per_bene double, cost_per_beneficiary double, "
        "total_beneficiaries long, is_fraud_label int")


def row(npi, spec, claims, brand=0.3, opioid=0.1, cpb=2.0, cost=None, cpc=10.0):
    return (npi, spec, claims, float(cost if cost is not None else claims * 10), cpc, brand, opioid, cpb, 50.0, 20, 0)


def test_features_edge_cases(spark):
    rows = [row("1", "Solo", 5, brand=0.70),                       # single-row group, brand exactly .70
            row("2", "Ties", 1), row("3", "Ties", 2), row("4", "Ties", 2), row("5", "Ties", 3),
            row("6", "Flat", 7, cpc=4.0), row("7", "Flat", 7, cpc=4.0),
            row("8", None, 9, opioid=0.5)]                       # NULL specialty
    df = spark.createDataFrame(rows, COLS)
    bench, feats = P.build_features(df)
    f = {r.npi: r for r in feats.collect()}
    assert f["1"].z_total_claim_count is None and f["1"].pct_total_claim_count == 1.0
    assert f["1"].flag_high_volume == 0 and f["1"].flag_brand_heavy == 0
    assert [f[k].pct_total_claim_count for k in "2345"] == [0.25, 0.625, 0.625, 1.0]
    assert f["6"].z_total_claim_count is None and f["6"].z_cost_per_claim is None      # constant metric
    assert f["8"].z_total_claim_count is None and f["8"].pct_total_claim_count is None
    assert f["8"].flag_high_volume == 0 and f["8"].flag_opioid_heavy == 1 and f["8"].flag_count == 1
    b = {r.specialty: r for r in bench.collect()}
    assert set(b) == {"Solo", "Ties", "Flat"} and b["Ties"].n_providers == 4
    assert b["Solo"].std_total_claim_count is None
    assert abs(b["Ties"].p99_total_claim_count - 2.97) < 1e-12                           # linear interpolation
    # flag sum equals the count
    for r in feats.collect():
        assert sum(r[c] for c in P.FLAG_COLUMNS) == r.flag_count


def test_model_matrix_order_and_fill(spark):
    df = spark.createDataFrame([row("1", "A", 5), row("2", "A", 6)], COLS)
    _, feats = P.build_features(df)
    m = P.model_matrix(feats, fill_nulls=True)
    assert m.columns[:2] == ["npi", "specialty_description"] and m.columns[2:26] == P.FEATURE_COLUMNS
    assert m.where(F.col("z_total_claim_count").isNull()).count() == 0


def test_tiers_inclusive_cutoffs(spark):
    df = spark.createDataFrame([(0.80,), (0.60,), (0.40,), (0.3999,), (None,)], "s double")
    out = [r[0] for r in df.select(S.tier_of(F.col("s"))).collect()]
    assert out == ["CRITICAL", "HIGH", "MODERATE", "LOW", "LOW"]


def test_minmax_constant_is_zero(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 3.0)], "id int, v double")
    assert [r.out for r in S.minmax_scale(df, "v", "out").collect()] == [0.0, 0.0]
    df2 = spark.createDataFrame([(1, -1.0), (2, 1.0), (3, 0.0)], "id int, v double")
    got = {r.id: r.out for r in S.minmax_scale(df2, "v", "out", flip=True).collect()}
    assert got == {1: 1.0, 2: 0.0, 3: 0.5}


def test_top_reasons_order_and_format(spark):
    df = spark.createDataFrame([("1", 2.0, -0.9, 3.456, 0.5, 1.0, 0.1)],
                               "npi string, v_a double, i_a double, v_b double, i_b double, v_c double, i_c double")
    r = S.top_reasons(df, ["a", "b", "c"]).collect()[0]
    assert r.reason_1 == "a: 2.00 (impact -0.900)"
    assert r.reason_2 == "b: 3.46 (impact +0.500)"
    assert r.reason_3 == "c: 1.00 (impact +0.100)"


def test_confirmation_empty_tier(spark):
    df = spark.createDataFrame([("LOW", 1)], "fraud_tier string, is_fraud_label int")
    r = S.critical_confirmation(df).collect()[0]
    assert (r.n_critical, r.n_confirmed, r.confirmation_pct) == (0, 0, 0.0)
