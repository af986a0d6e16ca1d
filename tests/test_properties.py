"""Cross-report properties on the supplied data."""

import datetime as dt

from pyspark.sql import functions as F

from shopfloor.plans import catalog
from shopfloor.sources import streams
from shopfloor.streaming import bronze as bs

SF = "/root/testdata/sf0.001"


def test_revenue_totals_agree(spark):
    total = lambda df: df.agg(F.sum(F.col("total_revenue").cast("decimal(38,2)"))).first()[0]
    y = total(catalog.q_revenue_yearly(spark, SF))
    assert y == total(catalog.q_revenue_monthly(spark, SF)) == total(catalog.q_revenue_by_country_year(spark, SF))
    assert y == total(catalog.q_revenue_daily(spark, SF)) == total(catalog.q_aov_overall(spark, SF))


def test_retention_and_new_customer_bounds(spark):
    r = catalog.q_retention_rate(spark, SF)
    assert r.filter("retained_next_month < 0 OR retained_next_month > active_customers").count() == 0
    nvr = catalog.q_new_vs_returning(spark, SF)
    new_total = nvr.filter("customer_type = 'new'").agg(F.sum("customer_count")).first()[0]
    sales = catalog._sales(catalog._tables(spark, SF), "customer_id")
    assert new_total == sales.filter(F.col("customer_id").isNotNull()).select("customer_id").distinct().count()


def test_clv_has_one_row_per_customer_plus_guest(spark):
    clv = catalog.q_customer_lifetime_value(spark, SF)
    assert clv.filter("customer_id_clean = 'guest'").count() == 1
    assert clv.count() == clv.select("customer_id_clean").distinct().count()


def test_dq_summary_counts_all_checks(spark):
    out = {r.status: r.checks for r in catalog.q_dq_summary(spark, SF).collect()}
    assert sum(out.values()) == 45 and out.get("FAIL", 0) == 0


def test_watermark_dedup_stream(spark, scratch):
    topic = f"{scratch}/topic"
    t = dt.datetime(2024, 1, 1)
    rows = [(b"a", b"1", "t", 0, 0, t), (b"a", b"1", "t", 0, 1, t + dt.timedelta(seconds=5)),
            (b"b", b"2", "t", 0, 2, t), (b"b", b"2", "t", 0, 3, t)]
    spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp") \
        .write.parquet(topic)
    src = streams.bronze_envelope(streams.record_file_stream(spark, topic))
    dedup = bs.dedup_within_watermark(src, ["kafka_key"], "kafka_timestamp", "1 hour")
    q = dedup.writeStream.format("memory").queryName("wm_dedup").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("SELECT count(*) FROM wm_dedup").first()[0] == 2
