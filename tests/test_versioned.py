"""Versioned months: a broken write, its retry, and what readers see meanwhile."""

import pytest
from pyspark.sql import functions as F

from shopfloor.sinks import files, versioned


def _rows(spark, rows):
    return spark.createDataFrame(rows, "id int, year int, month int")


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_months_are_replaced_and_others_kept(spark, scratch):
    root = f"{scratch}/t"
    assert versioned.read(spark, root) is None and versioned.superseded(spark, root) == []
    assert versioned.write(_rows(spark, [(1, 2010, 1), (2, 2010, 2), (3, None, None)]), root, "b1")["rows"] == 3
    versioned.write(_rows(spark, [(20, 2010, 2), (21, 2010, 2), (4, 2010, 3)]), root, "b2")
    assert _ids(versioned.read(spark, root)) == [1, 3, 4, 20, 21]
    assert _ids(versioned.read(spark, root, only=[(2010, 2), (None, None)])) == [3, 20, 21]
    assert [p.split("version=")[1] for p in versioned.superseded(spark, root)] == ["b1/year=2010/month=2"]
    assert versioned.read(spark, root).columns == ["id", "year", "month"]


def test_a_full_write_replaces_all_months(spark, scratch):
    root = f"{scratch}/t"
    versioned.write(_rows(spark, [(1, 2010, 1), (2, 2010, 2)]), root, "b1")
    versioned.write(_rows(spark, [(3, 2010, 2)]), root, "b2", full=True)
    versioned.write(_rows(spark, [(4, 2010, 2)]), root, "b3")
    assert _ids(versioned.read(spark, root)) == [4]  # January went with the full write, though b3 replaced all of b2
    versioned.write(_rows(spark, [(1, 2010, 1)]).limit(0), root, "b4", full=True)
    empty = versioned.read(spark, root)
    assert empty.count() == 0 and empty.columns == ["id", "year", "month"]


def test_a_broken_write_loses_nothing_and_its_retry_starts_anew(spark, scratch):
    root = f"{scratch}/t"
    versioned.write(_rows(spark, [(1, 2010, 1), (2, 2010, 2)]), root, "b1")
    half = _rows(spark, [(10, 2010, 1), (11, 2010, 1), (12, 2010, 2)]).repartition(3, "id")
    broken = half.withColumn("id", F.when(F.col("id") == 12, F.raise_error("lost")).otherwise(F.col("id")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        versioned.write(broken, root, "b2")
    assert _ids(versioned.read(spark, root)) == [1, 2]
    # the months were written, the manifest was not switched: still as before
    files.write_partitioned(half, f"{root}/data/version=b2")
    assert _ids(versioned.read(spark, root)) == [1, 2]
    versioned.write(half, root, "b2")
    assert _ids(versioned.read(spark, root)) == [10, 11, 12]
    assert versioned.write(_rows(spark, [(99, 2010, 1)]), root, "b2") == {}  # the same batch again
    assert _ids(versioned.read(spark, root)) == [10, 11, 12]


def test_only_a_missing_path_means_no_table(spark, scratch):
    import os

    root = f"{scratch}/t"
    os.makedirs(f"{root}/manifest")
    with open(f"{root}/manifest/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        versioned.read(spark, root)
    with pytest.raises(Exception):
        versioned.write(_rows(spark, [(1, 2010, 1)]), root, "b1")
    with pytest.raises(ValueError):
        versioned.write(_rows(spark, [(1, 2010, 1)]), scratch, "a/b")


def test_silver_batch_broken_after_its_months_is_retried(spark, scratch, monkeypatch):
    import datetime as dt
    import json

    from shopfloor.sources.streams import bronze_envelope
    from shopfloor.streaming import silver_incremental as inc

    def envelopes(months, offset):
        rows = []
        for i, m in enumerate(months):
            order = {"event_type": "order_item_created", "invoice_id": f"{offset + i}", "stock_code": "A", "quantity": 1, "unit_price": 1.0,
                     "event_time": f"2010-{m:02d}-01 08:00:00", "total_amount": 1.0}
            rows.append((b"k", json.dumps(order).encode(), "t", 0, offset + i, dt.datetime(2024, 1, 1)))
        df = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
        return bronze_envelope(df, F.lit(dt.datetime(2024, 1, 1)).cast("timestamp"))

    path = f"{scratch}/silver"
    inc.merge_orders_batch(envelopes([1, 2, 3], 0), path, "s-0")
    write = versioned.files.write_partitioned

    def breaks(*args, **kw):
        write(*args, **kw)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(versioned.files, "write_partitioned", breaks)
    with pytest.raises(RuntimeError):
        inc.merge_orders_batch(envelopes([2, 4], 10), path, "s-1")
    monkeypatch.undo()
    assert versioned.read(spark, path).count() == 3
    for _ in range(2):
        inc.merge_orders_batch(envelopes([2, 4], 10), path, "s-1")
    assert sorted(r.invoice_id for r in versioned.read(spark, path).collect()) == ["0", "1", "10", "11", "2"]


def test_repeated_run_replaces_its_metrics(spark, scratch):
    from shopfloor.operators import quality as dq

    def checks(layer, actual):
        return spark.createDataFrame([("p", layer, "c", "0", actual, "PASS", "d")], ", ".join(f"{c} string" for c in dq.CHECK_COLUMNS))

    for run, layer, actual in (("1", "silver", "a"), ("1", "gold", "b"), ("2", "silver", "c"), ("1", "silver", "d")):
        files.append_metrics(dq.with_run(checks(layer, actual), run), f"{scratch}/m")
    got = sorted((r.run_id, r.layer, r.actual) for r in files.read_metrics(spark, f"{scratch}/m").collect())
    assert got == [("1", "gold", "b"), ("1", "silver", "d"), ("2", "silver", "c")]
