"""Session helpers.

Library code never creates a session on its own; these helpers are for the
runner, the bench and the tests.  Cluster settings (executor sizes, shuffle
partition counts for 100 TB) belong to the submitter; the defaults here only
make local runs sane.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package assumes.  AQE re-plans joins and
# coalesces/splits shuffle partitions at run time (including skew splits);
# UTC keeps date keys and month buckets independent of the host.
BASE_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "shopfloor",
    shuffle_partitions: int = 8,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the submitter sets it to shared storage and we only read it.
    Where it is unset a fresh scratch folder is taken on a local master; on a
    cluster that would be a folder of the driver's machine alone, so it raises.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {master}")
        current = _LOCAL_FALLBACK.get(id(spark)) or tempfile.mkdtemp(prefix="shopfloor-ckpt-")
        _LOCAL_FALLBACK[id(spark)] = current
        try:
            spark.conf.set("spark.checkpoint.dir", current)
        except Exception:  # some deployments refuse runtime changes of core settings
            pass
    try:  # RDD checkpoints (classic sessions only; Spark Connect has no SparkContext)
        spark.sparkContext.setCheckpointDir(current)
    except Exception:
        pass
    return current


_LOCAL_FALLBACK: dict[int, str] = {}


def pin(df, name: str):
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and return a DataFrame reading it.

    Cuts the lineage (a lost executor recomputes from the table, not from the
    sources) and, unlike ``Dataset.checkpoint``'s row files, later readers get
    column pruning and filter pushdown on the pinned table.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/pinned/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def pin_observed(df, name: str, metrics) -> tuple:
    """``pin``, and the values of named aggregates over the rows written.

    They are observed in the tasks that write, whose results Spark counts once
    each, so a lost executor does not change them."""
    from pyspark.sql import Observation

    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    stored = pin(df.observe(seen, *metrics), name)
    return stored, dict(seen.get)


def dealt(df, *columns):
    """``df`` dealt by the hash of ``columns`` (all by default) to the session's number of
    shuffle partitions, which the submitter sizes to the data.

    Adaptive execution merges the small tasks of a join and then sorts, parses or
    aggregates in the merged ones, whose memory grows with the input; it leaves a
    count asked for alone.  Rows that differ in any column go apart, so a key that
    many rows share is still spread over all tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *(columns or [f"`{c}`" for c in df.columns]))


def scale_conf(shuffle_bytes: int, target_partition_bytes: int = 256 * 1024**2,
               max_partition_bytes: int = 256 * 1024**2) -> dict[str, str]:
    """Suggested settings for a job that shuffles about ``shuffle_bytes``.

    The initial shuffle partition count is sized so each partition holds
    about ``target_partition_bytes`` (AQE then coalesces small ones and splits
    skewed ones to the same advisory size); scans read splits of
    ``max_partition_bytes``.  E.g. 20 TB shuffled -> ~80,000 partitions.
    """
    partitions = max(200, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(max_partition_bytes),
    }
