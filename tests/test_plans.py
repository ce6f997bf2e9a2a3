"""Physical-plan checks: pruning and pushdown reach the Parquet scan."""

from pyspark.sql import functions as F

from conftest import SF
from kestrel.operators.schema import drop_forbidden, positive_complete
from kestrel.plans.suite_rowwise import LINEITEM_POLICY, LINEITEM_TARGET
from kestrel.sources.tables import read_table


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_firewall_prunes_the_scan(spark):
    li = read_table(spark, SF, "lineitem")
    out = drop_forbidden(li, LINEITEM_POLICY, LINEITEM_TARGET).agg(F.sum("l_quantity"))
    plan = _plan(out)
    schema = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "l_quantity" in schema
    for c in ["l_orderkey", "l_returnflag", "l_shipdate", "l_linestatus", "l_extendedprice"]:
        assert c not in schema


def test_filters_are_pushed_to_parquet(spark):
    o = read_table(spark, SF, "orders")
    plan = _plan(positive_complete(o, ["o_totalprice"]).select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,0.0)]" in plan


def _windows(plan: str) -> list[str]:
    return [line for line in plan.split("\n") if "Window [" in line]


def test_exact_rank_window_is_bucketed(spark):
    from kestrel.operators.split import exact_rank
    o = read_table(spark, SF, "orders").select("o_orderkey", "o_orderstatus")
    plan = _plan(exact_rank(o, ["o_orderstatus"], ["o_orderkey"]))
    rn = [w for w in _windows(plan) if "row_number()" in w]
    assert rn and all("__b" in w.split("row_number()")[1] for w in rn)   # partitioned by (class, bucket)


def test_score_table_running_sums_are_bucketed(spark):
    from kestrel.operators.metrics import score_table
    from kestrel.plans.fixtures import s_table
    plan = _plan(score_table(s_table(spark, SF), ["p_0", "p_1", "p_2"]))
    sums = [w for w in _windows(plan) if "sum(pos#" in w]
    assert sums and all("__pid" in w for w in sums)
