"""SURVEY §2.16 decisions not covered elsewhere."""

import datetime as dt
import json

from pyspark.sql import functions as F

from shopfloor.operators import dimensions as dims
from shopfloor.operators import facts, silver
from shopfloor.operators import quality as dq
from shopfloor.operators import reports as rep
from shopfloor.sources.streams import bronze_envelope

T0 = dt.datetime(2010, 12, 1, 8, 26)


def _bronze(spark, payloads, offsets=None):
    offsets = offsets or list(range(len(payloads)))
    recs = [(b"k", p.encode(), "t", 0, o, T0) for p, o in zip(payloads, offsets)]
    df = spark.createDataFrame(recs, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    return bronze_envelope(df, F.lit(T0).cast("timestamp"))


def _order(**kw):
    base = dict(event_type="order_item_created", invoice_id="1", stock_code="A", description="d", quantity=1,
                unit_price=2.0, country="UK", customer_id=7, event_time="2010-12-01 08:26:00",
                total_amount=2.0, ingestion_time="2010-12-01 09:00:00")
    base.update(kw)
    return json.dumps(base)


def _cust(cid, t="2010-12-01 08:26:00", country="UK"):
    return json.dumps({"event_type": "customer_activity", "customer_id": cid, "country": country,
                       "first_seen_time": t})


def test_replayed_topic_collapses_in_silver(spark):
    # SEM-21: an at-least-once replay resends rows; the 4-key dedup removes them
    rows = [_order(invoice_id=str(i)) for i in range(4)]
    once = silver.silver_orders(_bronze(spark, rows))
    twice = silver.silver_orders(_bronze(spark, rows + rows, offsets=list(range(8))))
    cols = ["invoice_id", "stock_code", "quantity", "event_time", "unit_price"]
    assert sorted(map(tuple, once.select(cols).collect())) == sorted(map(tuple, twice.select(cols).collect()))


def test_null_event_type_is_a_sale_and_flagged(spark):
    # SEM-18: null event type counts as a sale in the fact; the null check reports it
    b = _bronze(spark, [_order(event_type=None), _order(invoice_id="2")])
    so = silver.silver_orders(b)
    fact = facts.fact_order_items(so)
    assert fact.filter(~F.col("is_cancelled")).count() == 2
    cb = _bronze(spark, [_cust(7)])
    checks = {r.check_name: r for r in dq.silver_checks(b, cb, so, silver.silver_customers(cb)).collect()
              if r.pipeline == "retail_orders"}
    assert checks["null_check_event_type"].status == "WARN"
    assert checks["business_rule_event_type_values"].status == "PASS"  # null is not flagged (3-valued logic)


def test_customer_seen_twice_fans_out(spark):
    # SEM-17: two first-seen rows for one customer are both kept by silver;
    # duplicate checks fail and the per-customer report fans out
    cb = _bronze(spark, [_cust(7, "2010-12-01 08:26:00"), _cust(7, "2010-12-05 10:00:00", "FR")])
    sc = silver.silver_customers(cb)
    assert sc.count() == 2
    dc = dims.dim_customer(sc)
    ob = _bronze(spark, [_order()])
    so = silver.silver_orders(ob)
    checks = {r.check_name + r.pipeline: r.status for r in dq.silver_checks(ob, cb, so, sc).collect()}
    assert checks["duplicate_checkretail_customers"] == "FAIL"
    top = rep.top_customers_by_orders(rep.confirmed_sales(facts.fact_order_items(so)), dc)
    assert top.count() == 2
    fixed = dims.dim_customer(dims.earliest_per_customer(sc))
    assert [(r.customer_id, r.country) for r in fixed.collect()] == [("7", "UK")]


def test_country_semantics_of_customers_per_country(spark):
    # SEM-16: head count by first-seen country, revenue by the sale's country
    dc = spark.createDataFrame([("1", "UK", T0, 2010, "c"), ("2", "UK", T0, 2010, "c")],
                               "customer_id string, country string, first_seen_time timestamp, "
                               "first_seen_year int, cohort string")
    sales = spark.createDataFrame([("9", "1", "FR", 10.0), ("9", None, "UK", 5.0)],
                                  "invoice_id string, customer_id string, country string, total_amount double")
    got = {r.country: (r.total_customers, r.total_revenue) for r in rep.customers_per_country(sales, dc).collect()}
    assert got == {"UK": (2, None)}  # the FR sale has no registered-customer row; the guest sale is excluded


def test_gold_layer_on_empty_silver(spark):
    """SEM-19/20: an empty run produces empty reports and well-defined checks."""
    from shopfloor.plans.gold import gold_from_silver

    ob = _bronze(spark, [_order()]).limit(0)
    cb = _bronze(spark, [_cust(1)]).limit(0)
    so, sc = silver.silver_orders(ob), silver.silver_customers(cb)
    g = gold_from_silver(so, sc)
    for name, df in g.items():
        if name in ("aov_overall", "basket_size_overall"):
            assert df.count() == 1, name  # global aggregates: one row of nulls/zeros
        else:
            assert df.count() == 0, name
    checks = dq.gold_checks(g["fact_order_items"], g["dim_product"], g["dim_customer"], g["dim_date"],
                            g["revenue_yearly"], g["revenue_monthly"], g["aov_monthly"],
                            g["customer_lifetime_value"], g["retention_rate"], g["basket_size_monthly"],
                            g["new_vs_returning"], silver_orders=so).collect()
    assert len(checks) == 25 and all(r.status in ("PASS", "WARN", "FAIL") for r in checks)


def test_gold_checks_fail_on_seeded_defects(spark):
    from shopfloor.plans.gold import gold_from_silver

    so = silver.silver_orders(_bronze(spark, [_order(invoice_id=str(i), event_time=f"2010-0{m}-01 08:00:00")
                                              for i, m in enumerate([1, 2, 3])]))
    sc = silver.silver_customers(_bronze(spark, [_cust(7)]))
    g = gold_from_silver(so, sc)
    fact = g["fact_order_items"]
    bad_fact = fact.unionByName(fact.limit(1).withColumn("total_amount", F.lit(-5.0))
                                .withColumn("stock_code", F.lit("ZZZ")).withColumn("date_key", F.lit(19000101)))
    bad_products = g["dim_product"].unionByName(g["dim_product"])  # duplicate stock codes
    checks = {r.check_name: r.status for r in dq.gold_checks(
        bad_fact, bad_products, g["dim_customer"], g["dim_date"], g["revenue_yearly"], g["revenue_monthly"],
        g["aov_monthly"], g["customer_lifetime_value"], g["retention_rate"], g["basket_size_monthly"],
        g["new_vs_returning"], silver_orders=so).collect()}
    assert checks["row_count_vs_silver"] == "FAIL"          # one extra fact row
    assert checks["no_negative_total_amount"] == "FAIL"
    assert checks["referential_integrity_date_key"] == "FAIL"
    assert checks["referential_integrity_stock_code"] == "FAIL"
    assert checks["duplicate_stock_codes"] == "FAIL"
    assert checks["no_negative_quantity"] == "PASS" and checks["event_split_created"] == "PASS"
