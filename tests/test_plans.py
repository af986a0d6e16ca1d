"""Physical-plan shape of every registered query (scale guards)."""

import re

import pytest

from shopfloor.plans import catalog

SF = "/root/testdata/sf0.001"
QUERIES = catalog.queries()  # optional operators have their own tests

# Orderings allowed for a window without PARTITION BY: bounded sets only
# (calendar months, rank-range buckets, funnel steps).
BOUNDED_ORDER = {"year", "month", "__rank_bucket", "step"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "localCheckpoint")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"
    for spec in re.findall(r"windowspecdefinition\(([^)]*)\)", plan):
        # an unpartitioned window lists only ORDER BY items before the frame
        items = [i.strip() for i in spec.split(",")]
        if all(" ASC" in i or " DESC" in i or "Frame" in i or "preceding" in i or "following" in i
               or "currentrow" in i or i.startswith("-") or i.isdigit() for i in items):
            cols = {re.sub(r"#\d+.*", "", i) for i in items if " ASC" in i or " DESC" in i}
            assert cols <= BOUNDED_ORDER, f"{name}: whole-table window ordered by {cols}"


def test_scans_are_pruned(spark):
    plan = _plan(QUERIES["revenue_monthly"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan) or re.findall(r"struct<([^>]*)>", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all("l_tax" not in s and "l_shipdate" not in s for s in lineitem)
    assert "Not(EqualTo(l_returnflag,R))" in plan  # cancellation filter pushed into the scan


def test_window_guard_catches_whole_table_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = spark.range(10).withColumn("r", F.dense_rank().over(Window.orderBy(F.col("id").desc())))
    specs = re.findall(r"windowspecdefinition\(([^)]*)\)", _plan(df))
    cols = {re.sub(r"#\d+.*", "", i.strip()) for s in specs for i in s.split(",") if " DESC" in i}
    assert cols == {"id"} and not cols <= BOUNDED_ORDER
    ok = re.findall(r"windowspecdefinition\(([^)]*)\)", _plan(QUERIES["revenue_monthly"](spark, SF)))
    assert ok and all("year" in s and "month" in s for s in ok)


def test_skew_sensitive_steps_pre_aggregate(spark):
    silver_plan = _plan(QUERIES["silver_orders"](spark, SF))
    assert "partial_min(" in silver_plan  # dedup: one row per key leaves each task
    clv_plan = _plan(QUERIES["customer_lifetime_value"](spark, SF))
    assert "partial_count(distinct" in clv_plan or "partial_count(" in clv_plan
    first_seen = _plan(QUERIES["customer_events"](spark, SF))
    assert "partial_min(" in first_seen
