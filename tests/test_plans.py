"""Plan guards: column pruning on the big scan, no row-at-a-time Python UDFs."""

from peerscope.plans.registry import catalog_queries
from peerscope.sources.fixture import order_year_facts

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_claim_line_scan_is_pruned(spark):
    plan = _plan(order_year_facts(spark, SF))
    scans = [ln for ln in plan.splitlines() if "lineitem.parquet" in ln or "ReadSchema" in ln]
    lineitem = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "l_orderkey" in ln]
    assert lineitem, scans
    scan = lineitem[0]
    for col in ("l_orderkey", "l_partkey", "l_extendedprice", "l_linestatus", "l_shipdate"):
        assert col in scan
    for col in ("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_suppkey"):
        assert col not in scan


def test_catalog_plans_have_no_row_python_udfs(spark):
    q = catalog_queries()
    for name in ("f1_peer_outliers", "f3_concentrated_beneficiaries", "f7_state_concentration", "i4_geographic_clustering"):
        df = q[name](spark, SF)
        df.collect()
        plan = _plan(df)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_peer_joins_are_broadcast_behind_a_size_check(spark):
    """One row per specialty or state is joined without shuffling the providers on that key."""
    from peerscope.operators import clean as C
    from peerscope.operators import reports as R
    from peerscope.plans.views import workspace
    q, ws = catalog_queries(), workspace(spark, SF)
    frames = {n: q[n](spark, SF) for n in ("f1_peer_outliers", "f2_brand_heavy", "r1_zscore_ranking")}
    frames["a20"] = R.peer_comparison(ws.providers_scored)
    frames["c6"] = C.drop_cost_outliers(ws.providers_raw)
    for name, df in frames.items():
        plan = _plan(df)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, name


def test_large_side_is_not_broadcast(spark):
    from peerscope.functions import bounded_broadcast
    small, large = spark.range(10), spark.range(50)
    assert "broadcast" in bounded_broadcast(small, 10)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in bounded_broadcast(large, 10)._jdf.queryExecution().logical().toString().lower()


def _exchanges(df, *columns) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange hashpartitioning" in ln and any(c in ln for c in columns) for ln in plan.splitlines())


def test_claim_lines_are_shuffled_once_by_order(spark):
    """Grouping, join and window use one partitioning; money is added up as whole numbers."""
    df = order_year_facts(spark, SF)
    assert _exchanges(df, "l_orderkey") == 1
    assert dict(df.dtypes)["cents"] == "bigint"


def test_money_in_cents_is_the_decimal_cast(spark):
    from pyspark.sql import functions as F

    from peerscope.functions import money_cents
    values = [(x,) for x in (0.0, -0.0, 0.1, 0.29, 1.005, 2.675, -1.115, 84197.04, 1e9 + 0.01, 1e13 + 0.25, -3.14159, None)]
    df = spark.createDataFrame(values, "x double").select(money_cents("x").alias("got"), (F.col("x").cast("decimal(18,2)") * 100).cast("long").alias("want"))
    assert all(r.got == r.want for r in df.collect())


def test_growing_sides_are_not_gathered(spark):
    """Joins of tables that both grow with the input stay shuffle joins, however few the rows."""
    from peerscope.functions import growing
    from peerscope.operators.peers import build_features
    from peerscope.operators.scoring import global_pct_ranks
    rows = [(f"{k}", "ab"[k % 2], *[float(k * j % 7) for j in range(1, 8)]) for k in range(30)]
    names = ["total_claim_count", "total_drug_cost", "cost_per_claim", "brand_share", "opioid_share", "claims_per_bene", "cost_per_beneficiary"]
    p = spark.createDataFrame(rows, "npi string, specialty string, " + ", ".join(f"{n} double" for n in names))
    by_key = [build_features(p)[1], global_pct_ranks(p, names[:2]), spark.range(5).join(growing(spark.range(3)), "id")]
    for df in by_key:
        df.collect()
        assert "SortMergeJoin" in _plan(df)


def test_customer_years_count_an_episode_of_two_years_once(spark, tmp_path):
    """Lines without an order, orders without a customer and orders that come twice included."""
    from datetime import datetime

    from peerscope.sources import fixture as X

    def put(name, schema, *rows):
        spark.createDataFrame(list(rows), schema).write.parquet(f"{tmp_path}/{name}.parquet")

    day = lambda y: datetime(y, 5, 1)
    put("part", "p_partkey long, p_type string", (1, "LARGE"), (2, "SMALL"), (3, None))
    put("lineitem", "l_orderkey long, l_partkey long, l_extendedprice double, l_linestatus string, l_shipdate timestamp",
        (1, 1, 0.1, "F", day(2020)), (1, 2, 0.2, "O", day(2021)), (1, 2, 0.3, None, day(2021)), (2, 3, None, "F", day(2021)),
        (None, 1, 5.0, "F", day(2020)), (3, 1, 7.0, "F", day(2020)), (4, 1, 1.005, "F", None))
    put("orders", "o_orderkey long, o_custkey long", (1, 10), (2, 10), (3, None), (4, 11), (4, 11))
    put("customer", "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", (10, "A#1", 0, 1.0, "s"), (11, "B#2", 0, -1.0, "s"))
    put("nation", "n_nationkey int, n_name string", (0, "N"))
    columns = ["npi", "total_claim_count", "total_drug_cost", "total_beneficiaries", "brand_claim_count", "opioid_claim_count", "opioid_bene_count"]
    whole = sorted(tuple(r) for r in X.providers_raw(spark, str(tmp_path)).select(*columns).collect())
    assert whole == [("1000000010", 4, 0.6, 2, 1, 2, 1), ("1000000011", 2, 2.02, 1, 2, 0, 0)]
    years = {(r.npi, r.data_year): (r.total_claim_count, r.total_drug_cost, r.total_beneficiaries) for r in X.provider_years_raw(spark, str(tmp_path)).collect()}
    assert years == {("1000000010", 2020): (1, 0.1, 1), ("1000000010", 2021): (3, 0.5, 2), ("1000000011", None): (2, 2.02, 2)}
