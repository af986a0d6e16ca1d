"""Work and memory that must not grow faster than the input."""

import os

from conftest import SF_SMALL, rows

from pyspark.sql import functions as F

from shopfloor.operators import events as evt
from shopfloor.operators import profile as pro
from shopfloor.operators import silver
from shopfloor.plans import catalog, catalog_profile
from shopfloor.sources.tables import TableSet


def _plan(df, part="executedPlan"):
    return getattr(df._jdf.queryExecution(), part)().toString()


def test_a_payload_is_written_once_whatever_is_asked_of_it(spark):
    plan = _plan(catalog_profile.q_nan_recovery(spark, SF_SMALL), "optimizedPlan")
    assert plan.count("StructsToJsonEvaluator") == 1


def test_bare_nan_changes_named_null_fields_only(spark):
    texts = ['{"description":null,"unit_price":1.5}', '{"customer_id":null,"total_amount":null}', '{"customer_id":null}', '{"a":1}', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    got = [r.v for r in df.select("i", evt.with_bare_nan("v").alias("v")).orderBy("i").collect()]
    assert got == ['{"description":NaN,"unit_price":1.5}', '{"customer_id":null,"total_amount":NaN}', '{"customer_id":null}', '{"a":1}', None]


def test_stage_funnel_parses_once_and_counts_as_stage_by_stage(spark):
    df = catalog_profile.q_stage_funnel(spark, SF_SMALL)
    assert "from_json" not in _plan(df, "optimizedPlan")  # four stages read what one pass has stored
    b = catalog_profile.nan_order_bronze(TableSet(spark, SF_SMALL))
    timed = silver.parse_orders(b, typed=True).filter(F.col("event_time").isNotNull())
    parsed = b.filter(F.get_json_object(F.regexp_replace("raw_json", r":\s*NaN", ": null"), "$.event_type").isNotNull())
    want = pro.stage_funnel([("bronze", b), ("parsed", parsed), ("event_time_present", timed), ("deduplicated", silver.silver_orders(b))])
    assert rows(df) == rows(want)


def test_lines_are_dealt_before_they_are_parsed_or_grouped(spark):
    for q in (catalog.q_silver_orders, catalog.q_silver_fact_order_items, catalog.q_revenue_monthly_from_events,
              catalog_profile.q_full_row_duplicates, catalog_profile.q_duplicate_excess, catalog_profile.q_missing_customer_lines):
        assert "REPARTITION_BY_NUM" in _plan(q(spark, SF_SMALL)), q.__name__


def test_copies_of_a_line_are_still_found_after_dealing(spark, scratch):
    for name in ("orders", "customer", "nation", "part"):
        os.symlink(f"{SF_SMALL}/{name}.parquet", f"{scratch}/{name}.parquet")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(40)
    twice = li.unionByName(li.withColumn("l_linenumber", F.lit(99)))  # same eight raw columns, another line number
    twice.write.parquet(f"{scratch}/lineitem.parquet")
    assert catalog_profile.q_full_row_duplicates(spark, scratch).first()[0] >= 40
    assert catalog_profile.q_duplicate_lines(spark, scratch).count() == 80


def test_gold_checks_read_the_fact_from_stored_silver(spark, monkeypatch):
    stored = []
    real = catalog.pin_observed
    monkeypatch.setattr(catalog, "pin_observed", lambda df, name, metrics: (stored.append(name), real(df, name, metrics))[1])
    found = {r.check_name: r for r in catalog.q_dq_gold_checks(spark, SF_SMALL).collect()}
    assert sorted(stored) == ["silver_customers", "silver_orders"]
    assert found["row_count_vs_silver"].status == "PASS" and found["revenue_reconciliation_vs_fact"].status == "PASS"
