"""Tables of versioned months behind a small manifest.

```
<root>/data/version=<batch>/year=Y/month=M/part-*.parquet
<root>/manifest/part-*.parquet     one file a commit, a row per month it replaces
```

A write puts the months it replaces into a folder of its own version and then,
last, appends one file to the manifest.  That file appears as a whole or not at
all, so a reader sees every month either before or after the write: of the
commits since the last full one, the newest that names a month holds it.

* A write that breaks leaves the manifest, and with it every reader, as it was;
  the retry (same batch) starts its version folder anew.
* A batch that is in the manifest is not written again (``foreachBatch`` may call
  twice with the same batch).
* Old versions stay for running readers; ``superseded`` lists the folders that a
  storage rule or a clean-up job may delete.
* One writer a table.  Months are bounded by the calendar; nothing else reaches
  the driver.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.sinks import files

#: ``columns`` is the table's schema as JSON, so that an empty table can be read.
MANIFEST = "seq bigint, batch string, full boolean, year int, month int, rows bigint, columns string"
Month = tuple[int | None, int | None]


def _manifest(spark: SparkSession, root: str) -> DataFrame | None:
    """All commits, or None where there is no table; only a missing path means
    that, any other failure is raised."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{root.rstrip('/')}/manifest")
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def current(spark: SparkSession, root: str) -> list[dict]:
    """The newest commit of every month since the last full one (no rows: no table)."""
    manifest = _manifest(spark, root)
    if manifest is None:
        return []
    newest = F.max(F.struct("seq", "batch", "rows", "columns")).alias("last")
    full = F.max(F.when(F.col("full"), F.col("seq"))).alias("full")
    found = manifest.groupBy("year", "month").agg(newest, full).select("year", "month", "last.*", "full").collect()
    since = max((r["full"] for r in found if r["full"] is not None), default=0)
    return [r.asDict() for r in found if r["seq"] >= since]


def committed(spark: SparkSession, root: str, batch: str) -> bool:
    manifest = _manifest(spark, root)
    return manifest is not None and not manifest.filter(F.col("batch") == batch).isEmpty()


def _folder(root: str, version: str, month: Month | None = None) -> str:
    path = f"{root.rstrip('/')}/data/version={version}"
    if month is None:
        return path
    y, m = ("__HIVE_DEFAULT_PARTITION__" if v is None else v for v in month)
    return f"{path}/year={y}/month={m}"


def read(spark: SparkSession, root: str, only: Iterable[Month] | None = None) -> DataFrame | None:
    """The current rows (of the given months only), or None where there is no table.

    Months are chosen by their folders, so the others are not even listed."""
    commits = current(spark, root)
    if not commits:
        return None
    newest = max(commits, key=lambda r: r["seq"])
    schema = T.StructType.fromJson(json.loads(newest["columns"]))
    wanted = None if only is None else set(only)
    held = [r for r in commits if r["rows"] and (wanted is None or (r["year"], r["month"]) in wanted)]
    if not held:
        return spark.createDataFrame([], schema)
    paths = [_folder(root, r["batch"], (r["year"], r["month"])) for r in held]
    rows = spark.read.schema(schema).option("basePath", f"{root.rstrip('/')}/data").parquet(*paths)
    return rows.select(*schema.fieldNames())


def write(df: DataFrame, root: str, batch: str, full: bool = False, metrics: Sequence[Column] = (),
          files_per_partition: int | None = None) -> dict:
    """Replaces the months present in ``df`` (with ``full`` the whole table) by its
    rows; returns the values of ``metrics`` over them and their number as ``rows``."""
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"a batch names a folder: {batch!r}")
    spark = df.sparkSession
    if committed(spark, root, batch):
        return {}
    path = _folder(root, batch)
    seen = files.write_partitioned(df, path, files_per_partition=files_per_partition, metrics=metrics)
    written = spark.read.schema(df.schema).parquet(path).groupBy("year", "month").count().collect()
    manifest = _manifest(spark, root)
    last = None if manifest is None else manifest.agg(F.max("seq")).first()[0]
    entry = ((last or 0) + 1, batch, full)
    rows = [(*entry, r["year"], r["month"], r["count"], df.schema.json()) for r in written]
    rows = rows or [(*entry, None, None, 0, df.schema.json())]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/manifest")
    return seen | {"rows": sum(r["count"] for r in written)}


def superseded(spark: SparkSession, root: str) -> list[str]:
    """Month folders of committed versions that no reader starting now would open."""
    manifest = _manifest(spark, root)
    if manifest is None:
        return []
    live = {(r["batch"], r["year"], r["month"]) for r in current(spark, root)}
    every = manifest.filter("rows > 0").select("batch", "year", "month").distinct().collect()
    return sorted(_folder(root, b, (y, m)) for b, y, m in every if (b, y, m) not in live)
