import math
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from peerscope.operators import clean as C
from peerscope.operators import states as T
from peerscope.sources import files as S

METRICS = ["a", "b"]
SCHEMA = "npi string, specialty string, data_year int, a double, b double"


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    out = [(f"n{i % 400}", None if i % 97 == 0 else f"s{min(i % 5, 2)}", None if i % 89 == 0 else 2019 + i % 3,
            float(rng.normal(1e6, 1.0)), None if i % 7 == 0 else float("nan") if i % 11 == 0 else float(rng.integers(0, 9)))
           for i in range(3000)]
    out += [("one", "single", 2020, 4.0, None), ("one", "gone", 2019, 1.0, 2.0)]
    return spark.createDataFrame(out, SCHEMA)


def _expected(pdf, metric):
    out = {}
    for group, part in pdf.groupby("specialty"):
        x = part[metric].dropna()
        out[group] = (len(part), len(x), x.mean() if len(x) else None, x.std() if len(x) > 1 else None)
    return out


def _close(a, b):
    return (a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


def _check(bench, pdf):
    got = {(r["specialty"], r["metric"]): r for r in bench.collect()}
    want = {(g, m): v for m in METRICS for g, v in _expected(pdf, m).items()}
    assert set(got) == set(want)
    for k, (n_rows, n, avg, std) in want.items():
        r = got[k]
        assert (r["n_rows"], r["n"]) == (n_rows, n) and _close(r["avg"], avg) and _close(r["std"], std), (k, r, want[k])


def test_merged_and_subtracted_states_equal_one_pass(spark, rows):
    store = T.BenchmarkStore(spark, tempfile.mkdtemp(prefix="peerscope-states-") + "/s", metrics=METRICS)
    pdf = rows.toPandas().dropna(subset=["specialty", "data_year"])
    for y in (2019, 2020, 2021):
        store.put(rows.where(F.col("data_year") == y))
    _check(store.benchmarks(), pdf)
    _check(store.benchmarks(years=[2019, 2021]), pdf[pdf.data_year != 2020])
    _check(store.benchmarks(without=2019), pdf[pdf.data_year != 2019])      # "gone" has no rows left
    before = {r["data_year"]: r["c"] for r in store.states().groupBy("data_year").agg(F.count("*").alias("c")).collect()}
    store.put(rows.where("data_year = 2020").withColumn("a", F.lit(3.0)))
    pdf.loc[pdf.data_year == 2020, "a"] = 3.0
    _check(store.benchmarks(), pdf)
    assert before == {r["data_year"]: r["c"] for r in store.states().groupBy("data_year").agg(F.count("*").alias("c")).collect()}


def test_states_of_no_rows(spark, rows):
    empty = T.moment_states(rows.limit(0), metrics=METRICS)
    assert T.benchmarks_from_states(T.merge_states(empty, ["specialty", "metric"])).count() == 0
    assert T.merge_quantile_sketches(T.quantile_sketches(rows.limit(0), metrics=METRICS), ["specialty", "metric"]).count() == 0


def test_sketch_quantiles_within_rank_error(spark):
    n = 60_000
    wide = spark.range(n).select(F.col("id").cast("string").alias("npi"), F.lit("s").alias("specialty"), (F.col("id") % 4).cast("int").alias("data_year"),
                                 F.pmod(F.xxhash64("id"), F.lit(1000003)).cast("double").alias("a"), F.lit(7.0).alias("b"))
    merged = T.merge_quantile_sketches(T.quantile_sketches(wide, metrics=METRICS, k=200), ["specialty", "metric"])
    found = T.sketch_quantiles(merged, ["specialty", "metric"])
    ok = T.sketch_rank_checks(wide, found, metrics=METRICS, tolerance=2 * T.kll_rank_error(200)).collect()
    assert len(ok) == 6 and all(r["within"] for r in ok)
    # a value far off is noticed
    off = found.withColumn("value", F.col("value") * 2)
    assert not any(r["within"] for r in T.sketch_rank_checks(wide, off, metrics=["a"], tolerance=0.02).collect() if r["quantile"] == "p50")


def test_united_distinct_sketches(spark, rows):
    found = {r["specialty"]: r["n_estimated"] for r in T.distinct_counts(T.distinct_sketches(rows), ["specialty"]).collect()}
    pdf = rows.toPandas().dropna(subset=["specialty", "data_year"])
    for g, part in pdf.groupby("specialty"):
        assert abs(found[g] - part.npi.nunique()) <= 4 * T.hll_error() * part.npi.nunique() + 1


def test_years_are_replaced_and_recorded(spark):
    path = tempfile.mkdtemp(prefix="peerscope-years-") + "/t"
    first = spark.createDataFrame([("a", 2020), ("b", 2020), ("c", 2021)], "npi string, data_year int")
    S.write_years(first, path, run=1)
    for _ in range(2):
        S.write_years(spark.createDataFrame([("d", 2021)], "npi string, data_year int"), path, run=2)
    assert sorted(tuple(r) for r in S.read_years(spark, path).collect()) == [("a", 2020), ("b", 2020), ("d", 2021)]
    assert sorted(tuple(r) for r in S.read_manifest(spark, path).collect()) == [(2020, 1, 2), (2021, 2, 1)]
    with pytest.raises(ValueError, match="data_year"):
        S.write_years(spark.createDataFrame([("e", None)], "npi string, data_year int"), path, run=3)


def test_rejects_and_counts(spark):
    cols = C.REQUIRED_COLUMNS
    good = ["1000000001", "NY", "derm", "20", "5.0", "12", "1", "1", "1"]

    def row(**change):
        return [change.get(c, v) for c, v in zip(cols, good)]

    raw = spark.createDataFrame([good, row(total_claim_count="*"), row(total_claim_count="3"), row(total_beneficiaries=None),
                                 row(total_beneficiaries="1"), row(npi="  "), row(npi=None), row(npi="9000000001"),
                                 row(specialty_description=None)], ", ".join(f"{c} string" for c in cols))
    kept, rejected, seen = C.clean_with_counts(raw, tempfile.mkdtemp(prefix="peerscope-rejects-") + "/t")
    assert kept.count() == 2 and seen["n_rows"] == 9 and seen["n_kept"] == 2
    by = {r["reject_reason"]: r["count"] for r in rejected.groupBy("reject_reason").count().collect()}
    assert by == {k: v for k, v in seen.items() if k in C.REJECT_REASONS and v}
    assert by["npi_missing"] == 2 and by["npi_malformed"] == 1
    whole = C.clean_providers(raw)
    assert sorted(map(str, whole.select(*kept.columns).collect())) == sorted(map(str, kept.collect()))
