import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopfloor.operators import dimensions as dims
from shopfloor.operators import reports as rep
from shopfloor.operators.ranking import global_dense_rank

FACT = ("invoice_id string, stock_code string, customer_id string, country string, year int, month int, "
        "quantity int, total_amount double, is_cancelled boolean, event_time timestamp, date_key int")


def _fact(spark, rows):
    out = []
    for inv, code, cust, y, m, q, amt, canc in rows:
        t = dt.datetime(y, m, 1)
        out.append((inv, code, cust, "UK", y, m, q, amt, canc, t, int(t.strftime("%Y%m%d"))))
    return spark.createDataFrame(out, FACT)


def test_dim_date_range_and_empty(spark):
    o = spark.createDataFrame([(dt.datetime(2010, 12, 30, 9),), (dt.datetime(2011, 1, 2, 23),)], "event_time timestamp")
    d = dims.dim_date(o).orderBy("full_date").collect()
    assert [r.date_key for r in d] == [20101230, 20101231, 20110101, 20110102]
    assert [r.day_of_week for r in d][:2] == ["Thursday", "Friday"]
    assert [r.is_weekend for r in d] == [False, False, True, True]
    assert d[2].quarter == 1 and d[0].quarter == 4
    empty = spark.createDataFrame([], "event_time timestamp")
    assert dims.dim_date(empty).count() == 0  # SEM-19: no rows, no error


def test_dim_product_mode_tie_and_null_only(spark):
    o = spark.createDataFrame(
        [("A", "b"), ("A", "b"), ("A", "a"), ("A", "a"), ("A", None), ("B", None), ("C", "x")],
        "stock_code string, description string",
    )
    got = {r.stock_code: r.description for r in dims.dim_product(o).collect()}
    assert got == {"A": "a", "C": "x"}  # SEM-06 tie -> smallest; SEM-07 B absent


def test_dim_customer_cohorts_and_earliest(spark):
    c = spark.createDataFrame(
        [("1", "UK", dt.datetime(2009, 12, 1)), ("2", "FR", dt.datetime(2011, 1, 1)),
         ("1", "DE", dt.datetime(2010, 1, 1))],
        "customer_id string, country string, first_seen_time timestamp",
    )
    ref = {(r.customer_id, r.cohort) for r in dims.dim_customer(c).collect()}
    assert ref == {("1", "cohort_2009"), ("2", "unknown"), ("1", "cohort_2010")}  # SEM-17 fan-out kept
    every = {r.cohort for r in dims.dim_customer(c, None).collect()}
    assert every == {"cohort_2009", "cohort_2010", "cohort_2011"}
    first = {r.customer_id: r.country for r in dims.earliest_per_customer(c).collect()}
    assert first == {"1": "UK", "2": "FR"}


def test_revenue_monthly_gap_zero_and_near_tie(spark):
    f = _fact(spark, [
        ("1", "A", "c1", 2010, 1, 1, 0.0, False),   # revenue 0 in Jan
        ("2", "A", "c1", 2010, 3, 1, 10.0, False),  # Mar: previous *present* month is Jan (SEM-10)
        ("3", "A", "c1", 2010, 4, 1, 12.5, False),
        ("4", "A", "c1", 2010, 4, 1, 99.0, True),   # cancellation ignored
    ])
    got = [(r.month, r.total_revenue, r.prev_month_revenue, r.mom_change_pct)
           for r in rep.revenue_monthly(rep.confirmed_sales(f)).orderBy("month").collect()]
    assert got == [(1, 0.0, None, None), (3, 10.0, 0.0, None), (4, 12.5, 10.0, 25.0)]  # SEM-11: /0 -> null


def test_rank_on_rounded_revenue(spark):
    f = _fact(spark, [("1", "A", "c", 2010, 1, 1, 10.001, False), ("2", "B", "c", 2010, 1, 1, 10.004, False),
                      ("3", "C", "c", 2010, 1, 1, 9.0, False)])
    p = spark.createDataFrame([("A", "a"), ("B", "b"), ("C", "c")], "stock_code string, description string")
    got = {r.stock_code: r.revenue_rank for r in rep.top_products_global(rep.confirmed_sales(f), p).collect()}
    assert got == {"A": 1, "B": 1, "C": 2}  # SEM-08: both round to 10.00


def test_retention_across_year_end_and_last_month(spark):
    f = _fact(spark, [("1", "A", "c1", 2010, 12, 1, 1.0, False), ("2", "A", "c1", 2011, 1, 1, 1.0, False),
                      ("3", "A", "c2", 2010, 12, 1, 1.0, False), ("4", "A", None, 2010, 12, 1, 1.0, False)])
    got = {(r.year, r.month): (r.active_customers, r.retained_next_month, r.retention_rate_pct)
           for r in rep.retention_rate(rep.confirmed_sales(f)).collect()}
    assert got == {(2010, 12): (2, 1, 50.0), (2011, 1): (1, 0, 0.0)}  # SEM-12: last month 0


def test_invoice_over_two_months_and_same_code_twice(spark):
    f = _fact(spark, [("9", "A", "c", 2010, 1, 2, 4.0, False), ("9", "A", "c", 2010, 1, 1, 2.0, False),
                      ("9", "B", "c", 2010, 2, 3, 3.0, False)])
    s = rep.confirmed_sales(f)
    aov = {r.month: (r.total_invoices, r.avg_order_value) for r in rep.aov_monthly(s).collect()}
    assert aov == {1: (1, 6.0), 2: (1, 3.0)}  # SEM-13: counted in each month
    basket = {r.month: r.avg_basket_size for r in rep.basket_size_monthly(s).collect()}
    assert basket == {1: 2.0, 2: 1.0}  # SEM-14: lines, not distinct products


def test_clv_guest_row_and_new_vs_returning(spark):
    f = _fact(spark, [("1", "A", None, 2010, 1, 1, 5.0, False), ("2", "A", None, 2010, 2, 1, 5.0, False),
                      ("3", "A", "c1", 2010, 1, 1, 3.0, False), ("4", "A", "c1", 2010, 2, 1, 3.0, False)])
    s = rep.confirmed_sales(f)
    clv = {r.customer_id_clean: (r.lifetime_revenue, r.total_orders, r.avg_order_value, r.clv_rank)
           for r in rep.customer_lifetime_value(s).collect()}
    assert clv == {"guest": (10.0, 2, 5.0, 1), "c1": (6.0, 2, 3.0, 2)}  # SEM-15
    nvr = {(r.month, r.customer_type): r.customer_count for r in rep.new_vs_returning(s).collect()}
    assert nvr == {(1, "new"): 1, (2, "returning"): 1}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-5, 30)), min_size=1, max_size=60), st.integers(1, 6))
def test_global_dense_rank_equals_window(spark, values, buckets):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int")
    for desc in (True, False):
        got = {r.id: r.rk for r in global_dense_rank(df, "v", "rk", descending=desc, buckets=buckets).collect()}
        order = F.col("v").desc() if desc else F.col("v").asc()
        want = {r.id: r.rk for r in df.withColumn("rk", F.dense_rank().over(Window.orderBy(order))).collect()}
        assert got == want


def test_month_range_prunes_partitions(spark, scratch):
    from shopfloor.functions.periods import in_months
    from shopfloor.sinks import files

    f = _fact(spark, [("1", "A", "c", 2010, m, 1, 1.0, False) for m in range(1, 13)])
    files.write_partitioned(f, f"{scratch}/fact")
    stored = spark.read.parquet(f"{scratch}/fact").filter(in_months("2010-03", "2010-05"))
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    got = rep.revenue_monthly(rep.confirmed_sales(stored)).collect()
    assert sorted(r.month for r in got) == [3, 4, 5]


def test_global_dense_ranks_two_orders(spark):
    import random

    from shopfloor.operators.ranking import global_dense_ranks

    rnd = random.Random(9)
    data = [(i, rnd.randint(0, 20), rnd.choice([None, 1, 2, 3])) for i in range(200)]
    df = spark.createDataFrame(data, "id int, a int, b int")
    got = {r.id: (r.ra, r.rb) for r in global_dense_ranks(df, [("a", "ra", True), ("b", "rb", False)], 4).collect()}
    wa = {r.id: r.x for r in df.withColumn("x", F.dense_rank().over(Window.orderBy(F.col("a").desc()))).collect()}
    wb = {r.id: r.x for r in df.withColumn("x", F.dense_rank().over(Window.orderBy(F.col("b").asc()))).collect()}
    assert got == {i: (wa[i], wb[i]) for i in wa}


def test_global_dense_rank_with_aqe_sized_ranges(spark):
    import random

    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")  # many ranges for AQE to merge
    try:
        rnd = random.Random(3)
        df = spark.createDataFrame([(i, rnd.randint(0, 400)) for i in range(3000)], "id int, v int")
        got = {r.id: r.rk for r in global_dense_rank(df, "v", "rk").collect()}
        want = {r.id: r.rk for r in df.withColumn("rk", F.dense_rank().over(Window.orderBy(F.col("v").desc()))).collect()}
        assert got == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
