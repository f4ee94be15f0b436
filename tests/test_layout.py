"""Bucketed views: joins on npi without an exchange, lookups from one bucket, rows kept."""

import pytest
from pyspark.sql import functions as F

from peerscope.operators import catalog as K
from peerscope.operators import reports as R
from peerscope.plans.layout import BucketedViews, placement, store_bucketed
from peerscope.plans.views import workspace

SF = "/root/testdata/sf0.001"
BUCKETS = 6


@pytest.fixture(scope="module")
def stored(spark):
    return BucketedViews(workspace(spark, SF), BUCKETS)


@pytest.fixture
def shuffle_joins(spark):
    """Joins as tables too large to broadcast have them."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_joins_on_npi_need_no_exchange(stored, shuffle_joins):
    frames = {
        "J1": stored.flagged(), "J2 J3": stored.scored(), "J4": stored.excluded(),
        "F6": K.multi_flag(stored.scored(), stored.provider_features, flags_min=1),
        "I1": K.shared_pool_candidates(stored.scored(), stored.provider_features),
        "J6": stored.alerts.select("npi", "reason_1").join(stored.providers, "npi")}
    for name, df in frames.items():
        plan = _plan(df)
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan, name
        assert "Exchange" not in plan, (name, plan)


def test_plain_views_do_shuffle(spark, shuffle_joins):
    ws = workspace(spark, SF)
    assert "Exchange hashpartitioning(npi" in _plan(ws.providers.join(ws.scores, "npi"))


def test_results_equal_the_plain_views(stored):
    ws = stored.ws
    assert _rows(stored.scored()) == _rows(ws.providers_scored)
    assert _rows(K.multi_flag(stored.scored(), stored.provider_features, flags_min=1)) == _rows(
        K.multi_flag(ws.providers_scored, ws.provider_features, flags_min=1))
    assert stored.excluded().agg(F.sum("n_exclusions")).first()[0] == ws.exclusions.join(ws.providers, "npi", "left_semi").count()


def test_lookup_reads_one_bucket_of_each_view(stored, shuffle_joins):
    ws = stored.ws
    for npi in [r.npi for r in ws.providers.orderBy("npi").limit(2).collect()]:
        df = stored.lookup(f" {npi} ")
        plan = df._jdf.queryExecution().explainString(
            df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert plan.count(f"SelectedBucketsCount: 1 out of {BUCKETS}") == 3, plan
        assert _rows(df) == _rows(R.lookup(ws.providers_scored, npi))
    assert stored.lookup("none").count() == 0


def test_placement_and_files(spark, stored):
    got = {r["view"]: r for r in stored.placements().collect()}
    for view, r in got.items():
        assert r.n_rows == getattr(stored, view).count() and r.n_astray == r.n_split_keys == 0
    files = stored.providers.inputFiles()
    assert len(files) == BUCKETS       # one file a bucket
    jvm = spark._jvm
    for f in files:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
            jvm.org.apache.hadoop.fs.Path(f), spark.sparkContext._jsc.hadoopConfiguration())
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        for column in reader.getFooter().getBlocks().get(0).getColumns():
            if column.getPath().toDotString() == "npi":
                assert column.getBloomFilterOffset() > 0 and "DICTIONARY" not in column.getEncodings().toString()
        reader.close()


def test_null_repeated_and_no_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4), ("b", 5)], "npi string, x int")
    table = spark.table(store_bucketed(df, "edge", 3, n_keys=10))
    r = placement(table, 3).first()
    assert (r.n_rows, r.n_astray, r.n_split_keys) == (5, 0, 0)
    assert table.join(table.withColumnRenamed("x", "y"), "npi").count() == 5
    empty = spark.table(store_bucketed(df.limit(0), "edge", 3))
    assert empty.columns == ["npi", "x"] and empty.count() == 0
    r = placement(empty, 3).first()
    assert (r.n_rows, r.n_astray, r.n_split_keys) == (0, 0, 0)


def test_drop_forgets_the_tables(spark):
    own = BucketedViews(workspace(spark, SF), 2)
    assert own.scores.count() > 0
    name = own.tables["scores"]
    own.drop()
    assert not spark.catalog.tableExists(name) and own.scores.count() > 0
