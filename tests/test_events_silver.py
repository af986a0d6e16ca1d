import datetime as dt

from pyspark.sql import functions as F

from shopfloor.operators import events as evt
from shopfloor.operators import silver
from shopfloor.operators.dedup import keep_first, keep_first_window
from shopfloor.schemas import RAW_SALES
from shopfloor.sources.streams import bronze_envelope

T0 = dt.datetime(2010, 12, 1, 8, 26)


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW_SALES)


def _bronze(spark, payloads, offsets=None):
    """Bronze rows from raw JSON texts (one partition, offsets in order)."""
    offsets = offsets or list(range(len(payloads)))
    recs = [(b"k", (p.encode() if p is not None else None), "t", 0, o, T0) for p, o in zip(payloads, offsets)]
    df = spark.createDataFrame(recs, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    return bronze_envelope(df, F.lit(T0).cast("timestamp"))


def _order(**kw):
    base = dict(event_type="order_item_created", invoice_id="1", stock_code="A", description="d", quantity=1,
                unit_price=2.0, country="UK", customer_id=7, event_time="2010-12-01 08:26:00",
                total_amount=2.0, ingestion_time="2010-12-01 09:00:00")
    base.update(kw)
    import json

    return json.dumps(base)


def test_event_split_and_zero_quantity(spark):
    raw = _raw(spark, [
        ("1", "A", "x", 3, T0, 2.5, 7, "UK"),
        ("1", "B", "y", -2, T0, 1.0, 7, "UK"),
        ("2", "C", "z", 0, T0, 1.0, 8, "FR"),  # no order event (EVT-03)
    ])
    ev = evt.order_events(raw).orderBy("stock_code").collect()
    assert [(e.event_type, e.quantity, e.total_amount) for e in ev] == [
        ("order_item_created", 3, 7.5), ("order_item_cancelled", 2, 2.0)]


def test_customer_first_line_counts_zero_quantity(spark):
    raw = _raw(spark, [
        ("2", "C", "z", 0, T0, 1.0, 8, "FR"),  # first line, zero quantity (EVT-04)
        ("3", "C", "z", 5, T0 + dt.timedelta(days=1), 1.0, 8, "DE"),
        ("4", "C", "z", 5, T0, 1.0, None, "DE"),  # guest: no customer event
    ])
    got = evt.customer_events(raw).select("customer_id", "country", "first_seen_time").collect()
    assert [tuple(r) for r in got] == [(8, "FR", "2010-12-01 08:26:00")]


def test_records_keep_null_fields(spark):
    raw = _raw(spark, [("1", "A", None, 3, T0, 2.5, None, "UK")])
    value = evt.order_records(evt.order_events(raw)).first().value
    assert '"description":null' in value and '"customer_id":null' in value


def test_silver_parse_repair_and_drop(spark):
    payloads = [
        _order(invoice_id="1").replace('"description": "d"', '"description": NaN'),  # repaired (SEM-03)
        "garbage",  # unreadable -> dropped (SEM-01)
        "",
        None,
        _order(invoice_id="5", event_time="bad"),  # bad time dropped
        _order(invoice_id="6", quantity=None),  # null quantity -> 0 (SEM-04)
        _order(invoice_id="7").replace('"quantity": 1', '"quantity": 3.7'),  # wrong type -> null -> 0
        _order(invoice_id="8").replace('"stock_code": "A"', '"stock_code": 22041'),  # numeric code (SEM-22)
    ]
    out = {r.invoice_id: r for r in silver.silver_orders(_bronze(spark, payloads)).collect()}
    assert set(out) == {"1", "6", "7", "8"}
    assert out["1"].description is None
    assert out["6"].quantity == 0 and out["7"].quantity == 0
    assert out["8"].stock_code == "22041"
    assert out["1"].year == 2010 and out["1"].month == 12


def test_nan_inside_text_is_rewritten_by_default(spark):
    p = _order(description="note: NaN here")
    default = silver.parse_orders(_bronze(spark, [p])).first().description
    strict = silver.parse_orders(_bronze(spark, [p]), strict_nan=True).first().description
    assert default == "note: null here"  # SEM-02: kept for parity
    assert strict == "note: NaN here"


def test_dedup_keeps_first_arrival_and_distinct_quantities(spark):
    payloads = [
        _order(invoice_id="9", unit_price=2.0),
        _order(invoice_id="9", unit_price=3.0),  # same 4 keys, later offset: dropped (SEM-05)
        _order(invoice_id="9", quantity=2),  # same 3 keys, other quantity: kept
    ]
    out = silver.silver_orders(_bronze(spark, payloads, offsets=[5, 6, 7]))
    got = sorted((r.quantity, r.unit_price) for r in out.collect())
    assert got == [(1, 2.0), (2, 2.0)]


def test_keep_first_matches_window_version(spark):
    import random

    rnd = random.Random(4)
    data = [(rnd.choice(["a", "b", None]), rnd.randint(0, 3), rnd.randint(0, 50), rnd.choice(["x", "y", None]))
            for _ in range(300)]
    df = spark.createDataFrame(data, "k string, k2 int, o int, v string")
    a = sorted(map(tuple, keep_first(df, ["k", "k2"], ["o"]).collect()), key=repr)
    b = sorted(map(tuple, keep_first_window(df, ["k", "k2"], ["o"]).collect()), key=repr)
    assert a == b


def test_silver_customers(spark):
    import json

    mk = lambda cid, t: json.dumps({"event_type": "customer_activity", "customer_id": cid, "country": "UK",
                                    "first_seen_time": t})
    payloads = [mk(12, "2010-12-01 08:26:00"), mk(12, "2010-12-01 08:26:00"), mk(13, "bad"), mk(None, "x")]
    out = silver.silver_customers(_bronze(spark, payloads)).collect()
    assert sorted((r.customer_id, r.first_seen_time) for r in out) == [("12", T0), ("13", None)]


def test_zoned_event_times_become_utc_wall_clock(spark):
    import datetime as dt

    texts = {
        "2010-12-01 10:00:00": dt.datetime(2010, 12, 1, 10), "2010-12-01 10:00:00+05:00": dt.datetime(2010, 12, 1, 5),
        "2010-12-01T10:00:00Z": dt.datetime(2010, 12, 1, 10), "2010-12-01 01:30:00.25-03:00": dt.datetime(2010, 12, 1, 4, 30, 0, 250000),
        "2010-12-01 00:30:00 Europe/Paris": dt.datetime(2010, 11, 30, 23, 30), "2010-11-07T06:30:00Z": dt.datetime(2010, 11, 7, 6, 30),
        "2010-12-01": dt.datetime(2010, 12, 1), "1960-01-01 00:00:00Z": dt.datetime(1960, 1, 1),
        "bad": None, "2010-12-01 10:00:00 nowhere": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = {r.t: r.w for r in df.select("t", silver.wall_clock("t").alias("w")).collect()}
            assert got == texts, zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
