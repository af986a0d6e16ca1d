"""Bronze compaction next to a running stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shopfloor.sinks import compaction
from shopfloor.sources import streams
from shopfloor.streaming import bronze as bs


def _topic(spark, path, n, start):
    rows = [(f"k{i}".encode(), f'{{"i": {i}}}'.encode(), "t", 0, i, dt.datetime(2024, 1, 1)) for i in range(start, start + n)]
    df = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    df.repartition(20, "offset").write.mode("append").parquet(path)


def _drain(spark, scratch, name):
    q = bs.start_bronze(streams.record_file_stream(spark, f"{scratch}/topic"), f"{scratch}/bronze", f"{scratch}/ck", bs.AVAILABLE_NOW, name)
    bs.await_all(spark, [q])


def _hash(df):
    return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("kafka_key", "raw_json", "offset").cast("decimal(38,0)")), F.countDistinct("offset")).first()


def test_small_files_become_few_while_the_stream_goes_on(spark, scratch):
    sink, store = f"{scratch}/bronze", f"{scratch}/compacted"
    for k in range(3):
        _topic(spark, f"{scratch}/topic", 40, 100 * k)
        _drain(spark, scratch, f"c{k}")
    before = _hash(spark.read.parquet(sink))
    assert _hash(compaction.read(spark, sink, store)) == before  # nothing compacted yet
    n = len(spark.read.parquet(sink).inputFiles())
    done = compaction.compact(spark, sink, store, target_bytes=64 * 1024)
    assert n >= 10 and done["files"] == n and done["bins"] < n / 4
    packed = compaction.read(spark, sink, store)
    assert _hash(packed) == before and len(packed.inputFiles()) == done["bins"]
    # the stream restarts on its own files: no row lost, none twice
    _topic(spark, f"{scratch}/topic", 40, 900)
    _drain(spark, scratch, "c9")
    after = _hash(spark.read.parquet(sink))
    assert after[0] == before[0] + 40 and _hash(compaction.read(spark, sink, store)) == after
    again = compaction.compact(spark, sink, store, target_bytes=64 * 1024)
    assert 0 < again["files"] < n and _hash(compaction.read(spark, sink, store)) == after
    assert compaction.compact(spark, sink, store, target_bytes=64 * 1024)["files"] == 0


def test_a_broken_compaction_changes_nothing(spark, scratch, monkeypatch):
    sink, store = f"{scratch}/bronze", f"{scratch}/compacted"
    _topic(spark, f"{scratch}/topic", 40, 0)
    _drain(spark, scratch, "b0")
    before = _hash(spark.read.parquet(sink))
    real = compaction.replaced
    calls = []

    def breaks(*args):
        calls.append(args)
        if len(calls) == 2:  # the plan is made, rows are not moved
            raise RuntimeError("driver lost")
        return real(*args)

    monkeypatch.setattr(compaction, "replaced", breaks)
    with pytest.raises(RuntimeError):
        compaction.compact(spark, sink, store, target_bytes=64 * 1024)
    monkeypatch.undo()
    # rows moved, but not committed
    spark.read.parquet(sink).withColumn("bin", F.lit("0-0")).write.partitionBy("bin").parquet(f"{store}/data/batch=1")
    assert _hash(compaction.read(spark, sink, store)) == before
    compaction.compact(spark, sink, store, target_bytes=64 * 1024)
    assert _hash(compaction.read(spark, sink, store)) == before


def test_bins_hold_about_the_target(spark):
    sizes = [(f"f{i}", 1 + (i * 37) % 90) for i in range(500)]
    got = compaction.pack(spark.createDataFrame(sizes, "file string, bytes long"), 100).groupBy("bin").agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in got) == 500 and max(r.b for r in got) < 200 and len(got) < sum(s for _, s in sizes) / 100 * 1.5
