"""Parquet sinks.

Paths are parameters; object-store credentials come from the session
configuration the submitter provides (``sources.objectstore``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shopfloor.schemas import METRICS


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` instrumented to count the rows that flow through it; read
    ``obs.get["rows"]`` after the write (one pass, no second ``count()``)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_table(df: DataFrame, path: str, mode: str = "overwrite", metrics: Sequence[Column] = ()) -> dict:
    """SNK-02: (over)write an unpartitioned Parquet table; returns the values of
    ``metrics`` (named aggregates) over the rows written."""
    seen = Observation() if metrics else None
    (df.observe(seen, *metrics) if metrics else df).write.mode(mode).parquet(path)
    return dict(seen.get) if metrics else {}


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = ("year", "month"),
    mode: str = "overwrite",
    dynamic: bool = False,
    files_per_partition: int | None = None,
    metrics: Sequence[Column] = (),
) -> dict:
    """SNK-03 / SNK-08: Parquet partitioned by ``partition_cols``.

    Rows are clustered by the partition columns first (SNK-08), so each task
    writes few directories.  By default the clustering is a ``rebalance``:
    AQE splits a month that holds a third of all rows into advisory-size
    chunks written by many tasks, and merges small months, instead of one
    task per month as a plain hash repartition would do.  With
    ``files_per_partition`` a fixed, deterministic salt (a hash of the whole
    row) spreads every directory over exactly that many tasks.  ``dynamic``
    replaces only the partitions present in ``df`` (incremental rebuilds).

    Returns the values of ``metrics`` (named aggregates).  They are observed
    after the clustering, in the tasks that write: Spark counts each of these
    once, whereas a task before a shuffle is counted anew when it runs again
    after a lost executor.
    """
    cols = list(partition_cols)
    if files_per_partition and files_per_partition > 1:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_partition))
        df = df.repartition(*[F.col(c) for c in cols], salt)
    else:
        df = df.hint("rebalance", *cols)
    seen = Observation() if metrics else None
    if metrics:
        df = df.observe(seen, *metrics)
    writer = df.write.mode(mode).partitionBy(*cols)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return dict(seen.get) if metrics else {}


def append_metrics(metrics: DataFrame, path: str) -> None:
    """SNK-04: add check results to the one unified metrics table.  A run that is
    repeated under its ``run_id`` replaces the rows of the layers it writes."""
    writer = metrics.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_id", "layer").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metrics table; run ids stay text, whatever they look like."""
    return spark.read.schema(METRICS).parquet(path).select(*METRICS.fieldNames())


def quarantine(rows: DataFrame, root: str, run_id: str) -> str:
    """SNK-05: write offending rows under ``<root>/run_id=<id>/``; readers
    get ``run_id`` back as a string partition column.  Returns the path.
    Writing an empty set produces an empty folder, so callers that want
    "only when some exist" check ``rows.isEmpty()`` first."""
    path = f"{root.rstrip('/')}/run_id={run_id}"
    rows.write.mode("overwrite").parquet(path)
    return path


def read_quarantine(spark, root: str, run_id: str) -> DataFrame:
    """Read back one run's quarantined rows (partition discovery keeps
    ``run_id`` a string)."""
    spark_conf = {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}
    prev = {k: spark.conf.get(k, None) for k in spark_conf}
    try:
        for k, v in spark_conf.items():
            spark.conf.set(k, v)
        df = spark.read.parquet(root)
        return df.filter(F.col("run_id") == run_id)
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
