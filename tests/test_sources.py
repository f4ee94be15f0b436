import json
import os
import tempfile

import pytest

from peerscope.operators import clean as C
from peerscope.sources import files as S


def _write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


HEADER = ("npi,nppes_provider_last_org_name,nppes_provider_first_name,nppes_provider_state,specialty_description,"
          "total_claim_count,total_30_day_fill_count,total_drug_cost,total_beneficiaries,brand_claim_count,"
          "generic_claim_count,opioid_claim_count,opioid_bene_count,is_fraud_label\n")


def test_csv_source_keeps_npi_text_and_cleans(spark):
    d = tempfile.mkdtemp(prefix="peerscope-src-")
    _write(f"{d}/p.csv", HEADER + "0123456789,A,B,AZ,family practice,20,1,100.5,12,5,15,1,1,0\n"
                                  "1234567890,C,D,TX,family practice,*,1,100.5,12,5,15,1,1,1\n"
                                  "1234567891,E,F,TX,cardiology,30,2,300.0,15,abc,15,1,1,0\n")
    raw = S.read_providers_csv(spark, f"{d}/p.csv")
    assert raw.where("npi = '0123456789'").count() == 1          # leading zero kept as text
    out = C.to_provider_table(C.clean_providers(raw)).collect()
    assert [(r.npi, r.brand_claim_count, r.specialty) for r in out] == [("1234567891", 0, "Cardiology")]


def test_csv_columns_go_by_name(spark):
    d = tempfile.mkdtemp(prefix="peerscope-src-")
    names = HEADER.strip().split(",")
    row = dict(zip(names, "1234567891,E,F,TX,cardiology,30,2,300.0,15,5,15,1,1,0".split(",")))
    order = ["extra_1", *reversed([n for n in names if n != "opioid_bene_count"]), "Extra 2"]     # shuffled, extra, one optional missing
    _write(f"{d}/p.csv", ",".join(n.upper() if n == "npi" else n for n in order) + "\n" + ",".join(row.get(n, "zzz") for n in order) + "\n")
    got = S.read_providers_csv(spark, f"{d}/p.csv").collect()[0]
    assert got.asDict() == {**{n: row.get(n) for n in got.__fields__}, "opioid_bene_count": None}
    _write(f"{d}/q.csv", "npi,specialty_description\n1,x\n")
    with pytest.raises(ValueError, match="total_claim_count"):
        S.read_providers_csv(spark, f"{d}/q.csv")


def test_exclusions_of_the_public_layout(spark):
    d = tempfile.mkdtemp(prefix="peerscope-src-")
    _write(f"{d}/x.csv", "LASTNAME,FIRSTNAME,GENERAL,NPI,EXCLTYPE,EXCLDATE,REINDATE\nDOE,J,Médecin,1234567890,1128a1,20200115,00000000\n", "latin-1")
    ex = S.read_exclusions_csv(spark, f"{d}/x.csv").collect()[0]
    assert (ex.npi, str(ex.exclusion_date), ex.exclusion_type, ex.general, ex.reinstatement_date) == (
        "1234567890", "2020-01-15", "1128a1", "Médecin", None)


def test_profile_of_a_path(spark):
    d = tempfile.mkdtemp(prefix="peerscope-src-")
    _write(f"{d}/p.csv", "a,b\n1,2\n")
    r = S.profile_path(spark, f"{d}/p.csv", ["a"]).collect()[0]
    assert (r.exists_flag, r.size_bytes, r.n_rows, r.columns_ok) == (True, 8, 1, True)
    r = S.profile_path(spark, f"{d}/none.csv", ["a"]).collect()[0]
    assert (r.exists_flag, r.size_bytes, r.n_rows) == (False, 0, None)


def test_exclusions_latin1_and_dates(spark):
    d = tempfile.mkdtemp(prefix="peerscope-src-")
    _write(f"{d}/x.csv", "npi,exclusion_date,reinstatement_date,exclusion_type,general\n"
                         " 1234567890 ,20200115,,1128a1,Médecin\n1234567890,bad,,x,y\n", encoding="latin-1")
    ex = S.read_exclusions_csv(spark, f"{d}/x.csv").collect()
    assert ex[0].npi == "1234567890" and str(ex[0].exclusion_date) == "2020-01-15" and ex[0].general == "Médecin"
    assert ex[1].exclusion_date is None


def test_multi_year_union_profile_and_sinks(spark):
    d = tempfile.mkdtemp(prefix="peerscope-src-")
    _write(f"{d}/y1.csv", HEADER + "1234567890,A,B,AZ,x,20,1,10.0,12,5,15,1,1,0\n")
    _write(f"{d}/y2.csv", HEADER + "1234567890,A,B,AZ,x,40,1,10.0,12,5,15,1,1,0\n")
    multi = S.read_multi_year(spark, {2021: f"{d}/y1.csv", 2022: f"{d}/y2.csv"}, fmt="csv")
    assert sorted(r.data_year for r in multi.collect()) == [2021, 2022]
    prof = S.profile_source(multi, ["npi", "missing_col"]).collect()[0]
    assert prof.n_rows == 2 and prof.missing_columns == ["missing_col"] and not prof.columns_ok
    assert len(prof.sample_rows) == 2 and json.loads(prof.sample_rows[0])["npi"] == "1234567890"
    S.write_table(multi, f"{d}/out", partition_by=["data_year"])
    assert sorted(x for x in os.listdir(f"{d}/out") if x.startswith("data_year=")) == ["data_year=2021",
                                                                                   "data_year=2022"]
    S.write_json_metrics(spark.createDataFrame([(0.9, 0.99, 0.63)], "pr_auc double, roc_auc double, threshold double"),
                         f"{d}/metrics")
    parts = [f for f in os.listdir(f"{d}/metrics") if f.endswith(".json")]
    assert len(parts) == 1 and json.loads(open(f"{d}/metrics/{parts[0]}").read())["threshold"] == 0.63


def test_read_optional_missing_and_present(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("npi", T.StringType()), T.StructField("fraud_score_ensemble", T.DoubleType())])
    d = tempfile.mkdtemp(prefix="peerscope-src-")
    assert S.read_optional(spark, f"{d}/nope", schema).count() == 0
    spark.createDataFrame([("1", 0.5)], schema).write.parquet(f"{d}/scores")
    assert S.read_optional(spark, f"{d}/scores", schema).count() == 1


def test_all_year_queries_hold_every_year(spark):
    from peerscope.plans import registry_checks as K
    from peerscope.plans.views import workspace

    sf = "/root/testdata/sf0.001"
    want = {(r.npi, r.data_year) for r in workspace(spark, sf).provider_years.select("npi", "data_year").collect()}
    queries = K.check_queries()
    for name in ("s12_all_year_rows", "s8_w7_all_year_features"):
        got = [(r.npi, r.data_year) for r in queries[name](spark, sf).select("npi", "data_year").collect()]
        assert len({y for _, y in want}) > len(K.YEARS) and len(got) == len(want) and set(got) == want
        assert "data_year IN" not in K.check_sql()[name]
