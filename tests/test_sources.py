import datetime as dt

from shopfloor.operators import events as evt
from shopfloor.sources import adapter
from shopfloor.sources.objectstore import s3a_conf
from shopfloor.sources.raw import read_raw_sales
from shopfloor.sources.tables import TableSet

CSV = """Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country
489434,85048,15CM CHRISTMAS GLASS BALL 20 LIGHTS,12,2009-12-01 07:45:00,6.95,13085.0,United Kingdom
489435,22041,"RECORD FRAME 7"" SINGLE SIZE",x,2009-12-01 07:46:00,2.1,,United Kingdom
C489449,22087,PAPER BUNTING WHITE LACE,-12,bad date,2.95,16321.0,Australia
"""


def test_read_raw_sales_csv(spark, scratch):
    path = f"{scratch}/raw.csv"
    with open(path, "w") as f:
        f.write(CSV)
    rows = {r.Invoice: r for r in read_raw_sales(spark, path).collect()}
    assert rows["489434"].Quantity == 12 and rows["489434"]["Customer ID"] == 13085
    assert rows["489434"].InvoiceDate == dt.datetime(2009, 12, 1, 7, 45)
    assert rows["489435"].Quantity is None and rows["489435"]["Customer ID"] is None  # bad cell, not a failed job
    assert rows["C489449"].InvoiceDate is None and rows["C489449"].Quantity == -12
    ev = {r.invoice_id: r.event_type for r in evt.order_events(read_raw_sales(spark, path)).collect()}
    assert ev == {"489434": "order_item_created", "C489449": "order_item_cancelled"}


def test_s3a_conf_keys():
    conf = s3a_conf("http://store:9000", "k", "s", ssl=False)
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"


def test_adapter_column_pruning_skips_lookups(spark):
    t = TableSet(spark, "/root/testdata/sf0.001")
    plan = adapter.sales_lines(t, ["year", "total_amount"])._jdf.queryExecution().executedPlan().toString()
    assert "p_partkey" not in plan and "c_custkey" not in plan and "n_name" not in plan
    full = adapter.sales_lines(t)
    assert full.count() == t["lineitem"].count()  # every line kept


def test_jdbc_write_replaces_table_and_counts_rows(spark):
    from shopfloor.sinks import jdbc

    url = "jdbc:derby:memory:sinktest;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    first = spark.createDataFrame([(2010, 1, 10.5), (2010, 2, 7.25)], "year int, month int, total_revenue double")
    assert jdbc.write_table(first, url, "REVENUE_MONTHLY", props, num_partitions=2) == 2
    second = first.filter("month = 2")
    assert jdbc.publish({"REVENUE_MONTHLY": second}, url, props) == {"REVENUE_MONTHLY": 1}
    back = jdbc.read_table(spark, url, "REVENUE_MONTHLY", props).collect()
    assert [(r["year"], r["month"], r["total_revenue"]) for r in back] == [(2010, 2, 7.25)]


def test_read_raw_sales_parquet_round_trip(spark, scratch):
    raw = adapter.raw_sales_lines(TableSet(spark, "/root/testdata/sf0.001")).drop("LineNumber")
    raw.write.parquet(f"{scratch}/raw")
    back = read_raw_sales(spark, f"{scratch}/raw", fmt="parquet")
    assert [f.dataType.simpleString() for f in back.schema.fields] == \
        [f.dataType.simpleString() for f in raw.schema.fields]
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_kafka_source_fails_clearly_without_connector(spark):
    import pytest

    from shopfloor.sources import streams

    with pytest.raises(Exception) as err:
        streams.kafka_stream(spark, "broker:9092", "retail_order_events", max_offsets_per_trigger=1000,
                             options={"failOnDataLoss": "false"})
    assert "kafka" in str(err.value).lower()


def test_jdbc_replace_is_all_or_nothing(spark):
    import pytest
    from pyspark.sql import functions as F

    from shopfloor.sinks import jdbc

    url = "jdbc:derby:memory:swaptest;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}

    def held():
        return sorted(r.id for r in jdbc.read_table(spark, url, "T", props).collect())

    assert jdbc.write_table(spark.range(3).selectExpr("id", "1 AS v"), url, "T", props, num_partitions=2) == 3
    new = spark.range(10, 30, 1, 4).selectExpr("id", "2 AS v")
    broken = new.withColumn("v", F.when(F.col("id") == 29, F.raise_error("partition lost")).otherwise(F.col("v")).cast("int"))
    with pytest.raises(Exception, match="partition lost"):
        jdbc.write_table(broken, url, "T", props, num_partitions=4)
    assert held() == [0, 1, 2]  # the staging table is half full, the table is not touched
    with pytest.raises(Exception):
        with jdbc.transaction(spark, url, props) as statement:
            statement.executeUpdate("DELETE FROM T")
            statement.executeUpdate("INSERT INTO T SELECT * FROM NO_SUCH_TABLE")
    assert held() == [0, 1, 2]  # rolled back
    with pytest.raises(Exception):
        jdbc.write_table(spark.range(2).selectExpr("id", "'x' AS other"), url, "T", props)
    assert held() == [0, 1, 2]
    assert jdbc.write_table(new, url, "T", props, num_partitions=4) == 20 and held() == list(range(10, 30))
    assert jdbc.write_table(new.limit(0), url, "T", props) == 0 and held() == []
    assert jdbc.write_table(spark.range(2).selectExpr("id", "'x' AS other"), url, "T", props, recreate=True) == 2
