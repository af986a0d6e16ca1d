import datetime as dt
import json

import pandas as pd
from pyspark.sql import functions as F

from shopfloor.operators import profile as pro
from shopfloor.operators import quality as dq
from shopfloor.operators import silver
from shopfloor.sinks import files
from shopfloor.sources.streams import bronze_envelope

T0 = dt.datetime(2010, 12, 1, 8, 26)


def _bronze(spark, payloads):
    recs = [(b"k", p.encode(), "t", 0, i, T0) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(recs, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    return bronze_envelope(df, F.lit(T0).cast("timestamp"))


def _order(**kw):
    base = dict(event_type="order_item_created", invoice_id="1", stock_code="A", description="d", quantity=1,
                unit_price=2.0, country="UK", customer_id=7, event_time="2010-12-01 08:26:00",
                total_amount=2.0, ingestion_time="2010-12-01 09:00:00")
    base.update(kw)
    return json.dumps(base)


def _cust(cid):
    return json.dumps({"event_type": "customer_activity", "customer_id": cid, "country": "UK",
                       "first_seen_time": "2010-12-01 08:26:00"})


def _run(spark, orders, customers):
    ob, cb = _bronze(spark, orders), _bronze(spark, customers)
    so, sc = silver.silver_orders(ob, dedup=False), silver.silver_customers(cb)
    return {r.check_name + ":" + r.pipeline: r for r in dq.silver_checks(ob, cb, so, sc).collect()}


def test_silver_checks_clean_and_seeded(spark):
    clean = _run(spark, [_order(invoice_id=str(i), total_amount=10.0) for i in range(5)], [_cust(7)])
    assert len(clean) == 20
    assert clean["duplicate_check:retail_orders"].status == "PASS"
    assert clean["referential_integrity_customer_id:retail_orders"].status == "PASS"
    bad = _run(spark, [_order(), _order(), _order(invoice_id="2", quantity=0), _order(invoice_id="3", event_type="x"),
                       _order(invoice_id="4", customer_id=99)], [_cust(7)])
    assert bad["duplicate_check:retail_orders"].status == "FAIL"
    assert bad["business_rule_zero_quantity:retail_orders"].status == "FAIL"
    assert bad["business_rule_event_type_values:retail_orders"].status == "FAIL"
    assert bad["referential_integrity_customer_id:retail_orders"].actual == "1"
    assert bad["row_count_vs_raw:retail_orders"].details.startswith("Drop: ")


def test_silver_checks_on_empty_tables(spark):
    ob = _bronze(spark, [_order()]).limit(0)
    cb = _bronze(spark, [_cust(1)]).limit(0)
    out = dq.silver_checks(ob, cb, silver.silver_orders(ob), silver.silver_customers(cb)).collect()
    assert len(out) == 20  # SEM-20: no division error
    null_checks = [r for r in out if r.check_name.startswith("null_check")]
    assert all(r.status == "WARN" and r.actual == "null%" for r in null_checks)


def test_quarantine_roundtrip(spark, scratch):
    df = spark.createDataFrame([("1", 5)], "invoice_id string, customer_id int")
    files.quarantine(df, f"{scratch}/orphans", "20240101_000000")
    back = files.read_quarantine(spark, f"{scratch}/orphans", "20240101_000000")
    assert back.schema["run_id"].dataType.simpleString() == "string"
    assert back.count() == 1


def test_metrics_schema(spark):
    chk = spark.createDataFrame([("p", "l", "c", "0", "0", "PASS", "d")], ", ".join(f"{c} string" for c in dq.CHECK_COLUMNS))
    m = dq.with_run(chk, dq.new_run_id())
    assert [f.name for f in m.schema.fields][:2] == ["run_id", "run_timestamp"]
    assert dq.summary(m).first()["checks"] == 1


def test_offset_gaps_match_brute_force(spark):
    import random

    rnd = random.Random(1)
    data = [(p, o) for p in range(3) for o in sorted(rnd.sample(range(0, 200), 60))]
    df = spark.createDataFrame(data, "partition int, offset long")
    got = sorted(tuple(r) for r in pro.offset_gaps(df, range_size=16).select("partition", "prev_offset", "offset", "gap").collect())
    pdf = pd.DataFrame(data, columns=["partition", "offset"]).sort_values(["partition", "offset"])
    pdf["prev"] = pdf.groupby("partition")["offset"].shift()
    pdf = pdf[pdf["offset"] - pdf["prev"] > 1]
    want = sorted((int(a), int(b), int(c), int(c - b)) for a, b, c in zip(pdf["partition"], pdf["prev"], pdf["offset"]))
    assert got == want


def test_duplicates_and_conflicts_match_pandas(spark):
    import random

    rnd = random.Random(2)
    data = [(rnd.choice(["1", "2", None]), rnd.choice(["A", "B"]), rnd.randint(1, 3), rnd.choice(["x", "y"]))
            for _ in range(200)]
    df = spark.createDataFrame(data, "inv string, code string, qty int, other string")
    pdf = pd.DataFrame(data, columns=["inv", "code", "qty", "other"])
    members = pdf[pdf.duplicated(subset=["inv", "code", "qty"], keep=False)]
    assert pro.duplicate_members(df, ["inv", "code", "qty"]).count() == len(members)
    conf = pdf[pdf.duplicated(subset=["inv", "code"], keep=False)]
    conf = conf[~conf.duplicated(subset=["inv", "code", "qty"], keep=False)]
    assert pro.conflicting_records(df, ["inv", "code"], "qty").count() == len(conf)
    assert pro.full_row_duplicates(df).first()[0] == int(pdf.duplicated().sum())


def test_nan_recovery_and_funnel(spark):
    nan_row = _order(invoice_id="2").replace('"description": "d"', '"description": NaN')
    b = _bronze(spark, [_order(), nan_row, "junk"])
    assert pro.unreadable_json(b).count() == 2
    assert [tuple(r) for r in pro.nan_recovery(b).collect()] == [("order_item_created", 1)]
    funnel = pro.stage_funnel([("bronze", b), ("silver", silver.silver_orders(b))]).orderBy("step").collect()
    assert [(r.rows, r.dropped, r.warn) for r in funnel] == [(3, None, False), (2, 1, True)]


def test_null_or_empty_on_int_column(spark):
    df = spark.createDataFrame([(1,), (None,)], "customer_id int")
    assert df.filter(pro.null_or_empty("customer_id")).count() == 1  # no ANSI cast error


def test_partitioned_write_layout(spark, scratch):
    import os

    df = spark.range(0, 2000).select((F.col("id") % 3).cast("int").alias("year"), F.lit(1).alias("month"), "id")
    files.write_partitioned(df, f"{scratch}/p")
    files.write_partitioned(df, f"{scratch}/q", files_per_partition=4)
    back = spark.read.parquet(f"{scratch}/p")
    assert back.count() == 2000 and {"year", "month"} <= set(back.columns)
    n = [f for f in os.listdir(f"{scratch}/q/year=0/month=1") if f.endswith(".parquet")]
    assert 1 <= len(n) <= 4


def test_partition_profile(spark, scratch):
    df = spark.range(0, 100).repartition(5)
    counts = {r.spark_partition: r.rows for r in pro.rows_per_spark_partition(df).collect()}
    assert sum(counts.values()) == 100 and len(counts) == 5
    df.write.parquet(f"{scratch}/f")
    found = pro.file_count(spark.read.parquet(f"{scratch}/f")).first()
    assert (found.files, found.rows) == (5, 100)


def test_counted_write(spark, scratch):
    df, obs = files.counted(spark.range(0, 42), "n")
    files.write_table(df, f"{scratch}/c")
    assert obs.get["rows"] == 42


def test_describe_with_exact_quartiles(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(5)
    vals = [float(v) for v in rng.integers(1, 1000, 2000)] + [7.0] * 1500 + [float(v) for v in rng.normal(size=700)]
    rows = [(v, i) for i, v in enumerate(vals)] + [(None, 1), (float("nan"), 2), (float("inf"), 3), (float("-inf"), None)]
    df = spark.createDataFrame(rows, "x double, i int").withColumn("none", F.lit(None).cast("double"))
    out = {r["column"]: r for r in pro.describe_numeric(df, ["x", "i", "none"]).collect()}
    r = out["x"]
    q1, med, q3 = np.percentile(vals, [25, 50, 75])
    assert (r["count"], r.left_out, r.min, r.max) == (len(vals), 3, min(vals), max(vals))
    assert abs(r["mean"] - round(float(np.mean(vals)), 4)) < 1e-9 and abs(r.stddev - np.std(vals, ddof=1)) < 1e-4
    for got, want in ((r.q1, q1), (r.median, med), (r.q3, q3)):
        assert abs(got - want) < 1e-9
    assert (out["none"]["count"], out["none"].left_out, out["none"]["mean"], out["none"].median) == (0, 0, None, None)
    nan_one = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    r = pro.describe_numeric(nan_one, ["x"]).first()
    assert (r["count"], r.left_out, r["mean"], r.median, r.stddev) == (1, 1, 1.0, 1.0, None)  # the mean of the rows it counts


def test_quantiles_over_many_ranges(spark):
    import numpy as np

    prev = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        vals = {"a": [float(v % 53) for v in range(401)], "b": [1.5], "c": [2.0, 4.0]}
        counts = [(c, v, vs.count(v)) for c, vs in vals.items() for v in set(vs)]
        probabilities = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
        got = pro.exact_quantiles(spark.createDataFrame(counts, "column string, value double, rows long"), probabilities).collect()
        assert len(got) == 18
        assert all(abs(r["quantile"] - np.percentile(vals[r["column"]], 100 * r.probability)) < 1e-9 for r in got)
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)


def test_profiles_read_their_input_once(spark, scratch):
    rows = [("1", "A", 1, "x"), ("1", "A", 1, "x"), ("1", "A", 1, "y"), ("1", "A", 2, None), ("2", "B", None, "z"), ("2", "B", None, "z"), (None, "C", 1, "w"), (None, "C", 2, "w")]
    spark.createDataFrame(rows, "k string, s string, q int, d string").coalesce(1).write.parquet(f"{scratch}/in")
    df = spark.read.parquet(f"{scratch}/in")

    def got(out):
        return sorted(map(tuple, out.collect()), key=repr)

    assert got(pro.duplicate_members(df, ["k", "s", "q"])) == sorted([r for r in rows if r[1] != "C" and r[2] != 2], key=repr)
    assert got(pro.conflicting_records(df, ["k", "s"], "q")) == sorted([("1", "A", 2, None), (None, "C", 1, "w"), (None, "C", 2, "w")], key=repr)
    excess = pro.duplicate_excess(df, {"three": ["k", "s", "q"], "two": ["k", "s"]})
    assert tuple(excess.first()) == (3, 5)
    plan = excess._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    for out in (pro.duplicate_members(df, ["k", "s", "q"]), pro.conflicting_records(df, ["k", "s"], "q")):
        assert f"{scratch}/in" not in out._jdf.queryExecution().executedPlan().toString()  # read once, when counted
    many = spark.range(1).select(F.lit(25_001).cast("long").alias("__n"))
    assert pro._repeated(many, "__n").count() == 25_001


def test_funnel_counts_parsed_payloads(spark):
    b = _bronze(spark, [_order(), "garbage", _order(event_time="bad")])
    from shopfloor.functions.json import json_field, repair_nan

    parsed = b.filter(json_field(repair_nan("raw_json"), "$.event_type").isNotNull())
    rows = pro.stage_funnel([("bronze", b), ("parsed", parsed)]).orderBy("step").collect()
    assert [(r.rows, r.dropped) for r in rows] == [(3, None), (2, 1)]


def test_seeded_orphans_and_lookup(spark):
    ob = _bronze(spark, [_order(customer_id=7), _order(invoice_id="2", customer_id=99), _order(invoice_id="3", customer_id=None)])
    so, sc = silver.silver_orders(ob), silver.silver_customers(_bronze(spark, [_cust(7)]))
    assert [r.customer_id for r in dq.orphan_orders(so, sc).collect()] == [99]
    assert [r.invoice_id for r in pro.lookup(so, "customer_id", 7).collect()] == ["1"]
    totals = pro.description_totals(spark.createDataFrame([("A", "x"), ("A", "y"), ("A", None), ("B", "x")], "stock_code string, description string"))
    assert tuple(totals.first()) == (2, 1, 4)


def test_dynamic_overwrite_replaces_only_given_months(spark, scratch):
    base = spark.createDataFrame([(2010, m, f"old{m}") for m in (1, 2, 3)], "year int, month int, v string")
    files.write_partitioned(base, f"{scratch}/t")
    patch = spark.createDataFrame([(2010, 2, "new2")], "year int, month int, v string")
    files.write_partitioned(patch, f"{scratch}/t", dynamic=True)
    got = sorted((r.month, r.v) for r in spark.read.parquet(f"{scratch}/t").collect())
    assert got == [(1, "old1"), (2, "new2"), (3, "old3")]
