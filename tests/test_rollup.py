"""Exact money and the roll-ups that the reports are read from."""

import random

from pyspark.sql import functions as F

from shopfloor.functions.money import merge_sum, money_ratio, money_sum, money_total
from shopfloor.operators import reports as rep
from shopfloor.operators import rollup
from shopfloor.plans import gold
from shopfloor.sinks import files

FACT = ("invoice_id string, stock_code string, customer_id string, country string, year int, month int, "
        "quantity int, total_amount double, is_cancelled boolean, event_time timestamp, date_key int")


def _fact(spark, n=400, seed=5):
    import datetime as dt

    rnd, out = random.Random(seed), []
    for _ in range(n):
        t = dt.datetime(rnd.choice([2009, 2010]), rnd.randint(1, 12), rnd.randint(1, 28), rnd.randint(0, 23))
        amount = rnd.choice([round(rnd.uniform(0, 50), 2), 3 * 1.1, 0.004, 0.005, 17 * 1234.56, None, float("nan")])
        out.append((rnd.choice([None, *map(str, range(60))]), rnd.choice([None, *"ABCDEF"]), rnd.choice([None, "c1", "c2", "c3", "c4"]),
                    rnd.choice([None, "UK", "FR"]), t.year, t.month, rnd.choice([None, 1, 2, 7]), amount, rnd.random() < 0.2, t, int(t.strftime("%Y%m%d"))))
    return spark.createDataFrame(out, FACT)


def _dims(spark):
    days = spark.range(1).select(F.explode(F.expr("sequence(date'2009-01-01', date'2010-12-31')")).alias("full_date"))
    date = days.select(F.expr("cast(date_format(full_date, 'yyyyMMdd') as int)").alias("date_key"), "full_date", F.dayofmonth("full_date").alias("day"),
                       F.lit("x").alias("day_of_week"), F.lit(False).alias("is_weekend"))
    return {
        "dim_date": date,
        "dim_product": spark.createDataFrame([(c, c.lower()) for c in "ABCDE"], "stock_code string, description string"),
        "dim_customer": spark.createDataFrame([("c1", "UK", "k"), ("c2", "FR", "k"), ("c3", "UK", "k")], "customer_id string, country string, cohort string"),
    }


def test_amounts_are_rounded_once(spark):
    assert spark.createDataFrame([(0.004,)] * 3, "x double").agg(money_total("x").cast("double")).first()[0] == 0.01
    assert spark.createDataFrame([(1.005,)], "x double").agg(money_total("x").cast("double")).first()[0] == 1.01
    f = spark.createDataFrame([("1", 2010, 1, 0.004)] * 3, "invoice_id string, year int, month int, total_amount double")
    f = f.withColumn("quantity", F.lit(1)).withColumn("stock_code", F.lit("A"))
    assert rep.revenue_monthly(f).first().total_revenue == 0.01
    assert rep.aov_overall(f).first().total_revenue == 0.01
    assert rep.basket_size_overall(f).first().avg_basket_value == 0.01


def test_sums_have_the_same_bits_in_every_order(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(rnd.choice([rnd.uniform(-1e6, 1e6), round(rnd.uniform(0, 99), 2), 1e-9, 1e12]),) for _ in range(3000)], "x double")
    whole = df.agg(money_sum("x").alias("s")).first().s
    for k in range(4):
        mixed = df.orderBy(F.rand(k)).repartition(k + 2)
        assert mixed.agg(money_sum("x").alias("s")).first().s == whole
        parts = mixed.groupBy(F.spark_partition_id().alias("p")).agg(money_sum("x").alias("s"))
        assert parts.agg(merge_sum("s").alias("s")).first().s == whole


def test_sums_without_amounts(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),)], "x double")
    assert df.agg(money_sum("x").alias("s")).first().s is None
    assert df.limit(0).agg(money_total("x").alias("s")).first().s is None
    mean = spark.createDataFrame([(1.005, 1), (2.0, 0), (None, 1), (-1.005, 1)], "x double, n long")
    got = mean.select(money_ratio(F.col("x").cast("decimal(36,18)"), "n").alias("m")).collect()
    assert [r.m for r in got] == [1.01, None, None, -1.01]


def _scans(df, path):
    return df._jdf.queryExecution().executedPlan().toString().count(path)


def test_reports_from_roll_ups_equal_those_from_the_fact(spark, scratch):
    files.write_table(_fact(spark), f"{scratch}/the-fact")
    fact, d = spark.read.parquet(f"{scratch}/the-fact"), _dims(spark)
    scans = []

    def store(df, name):
        scans.append(_scans(df, "the-fact"))
        files.write_table(df, f"{scratch}/rollups/{name}")
        return spark.read.parquet(f"{scratch}/rollups/{name}")

    made = gold.rollups(fact, store)
    from_rollups, from_fact = gold.reports(made, d), gold.reports(fact, d)
    assert set(from_rollups) == set(gold.REPORTS) == set(rollup.SOURCE)
    assert sum(scans) == 2 and all(_scans(df, "the-fact") == 0 for df in from_rollups.values())
    for name in gold.REPORTS:
        a, b = from_rollups[name], from_fact[name]
        assert a.dtypes == b.dtypes, name
        key = lambda r: tuple(map(repr, r))
        assert sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key), name


def test_only_the_needed_roll_ups(spark):
    assert rollup.needed(["retention_rate"]) == ["invoice_day", "customer_month"]
    assert rollup.needed(["top_products_global"]) == ["product_month"]
    assert set(rollup.needed(gold.REPORTS)) == set(rollup.KEYS)
