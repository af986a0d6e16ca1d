"""Compaction of a bronze folder's small files, while its stream goes on.

The stream keeps appending to its folder, whose log of files it alone writes.
Compaction rewrites the rows of small files into files of about
``target_bytes`` under a folder of its own and then, last, appends one file to a
manifest that names the files replaced.  ``read`` opens the compacted files and
those of the stream that no commit replaces, so a row is seen once at any time:

```
<sink>/part-*.parquet                         the stream's files, untouched
<store>/data/batch=<n>/bin=<k>/part-*.parquet  compacted rows
<store>/manifest/part-*.parquet               (seq, batch, file), one file a commit
```

A compaction that breaks leaves no manifest row and is repeated as a whole.
Streams that read the folder go on reading its own files and are not affected.
Replaced files stay until a clean-up job removes them (``replaced``).

Bins are packed from file sizes: files are dealt to groups by hash, and each
group fills its bins by a running sum, so no task sees the whole listing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MANIFEST = "seq bigint, batch string, file string"
TARGET_BYTES = 128 * 1024**2
#: Bins that one group packs, about.
BINS_OF_A_GROUP = 64


def replaced(spark: SparkSession, store: str) -> DataFrame:
    """(seq, batch, file) of every replaced file; empty before the first commit."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{store.rstrip('/')}/manifest")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def _live_files(spark: SparkSession, sink: str, store: str) -> DataFrame:
    """(file, bytes) of the stream's files that no commit replaces, from file metadata."""
    meta = spark.read.parquet(sink).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    return meta.distinct().join(replaced(spark, store).select("file"), "file", "left_anti")


def pack(files: DataFrame, target_bytes: int) -> DataFrame:
    """(file, bytes) with the ``bin`` of each file; bins hold about ``target_bytes``."""
    total = files.agg(F.sum("bytes")).first()[0] or 0
    groups = max(1, -(-total // (target_bytes * BINS_OF_A_GROUP)))
    grouped = files.withColumn("__group", F.pmod(F.xxhash64("file"), F.lit(groups)))
    order = Window.partitionBy("__group").orderBy(F.col("bytes").desc(), "file")  # a group's files: bounded by its bytes' share
    filled = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    number = F.floor((filled - 1) / F.lit(target_bytes)).cast("long")
    return grouped.withColumn("bin", F.concat_ws("-", F.col("__group").cast("string"), number.cast("string"))).drop("__group")


def compact(spark: SparkSession, sink: str, store: str, target_bytes: int = TARGET_BYTES) -> dict[str, int]:
    """Rewrites the stream's small files (under half of ``target_bytes``) and
    returns how many files became how many."""
    top = store.rstrip("/")
    small = _live_files(spark, sink, store).filter(F.col("bytes") * 2 < target_bytes)
    seq = (replaced(spark, store).agg(F.max("seq")).first()[0] or 0) + 1
    plan, batch = f"{top}/plan/batch={seq}", str(seq)
    pack(small, target_bytes).write.mode("overwrite").parquet(plan)  # fixed before rows are moved: the stream goes on
    bins = spark.read.parquet(plan)
    n_files, n_bins = bins.agg(F.count(F.lit(1)), F.countDistinct("bin")).first()
    if n_files <= n_bins:
        return {"files": 0, "bins": 0}
    rows = spark.read.parquet(sink).select("*", F.col("_metadata.file_path").alias("file"))
    moved = rows.join(bins.select("file", "bin"), "file").drop("file")
    moved.repartition("bin").write.mode("overwrite").partitionBy("bin").parquet(f"{top}/data/batch={batch}")
    commit = bins.select(F.lit(seq).alias("seq"), F.lit(batch).alias("batch"), "file")
    commit.coalesce(1).write.mode("append").parquet(f"{top}/manifest")
    return {"files": int(n_files), "bins": int(n_bins)}


def read(spark: SparkSession, sink: str, store: str) -> DataFrame:
    """All rows of the folder, through compacted files where there are some."""
    stream = spark.read.parquet(sink)
    commits = replaced(spark, store)
    batches = sorted(r["batch"] for r in commits.select("batch").distinct().collect())
    if not batches:
        return stream
    paths = [f"{store.rstrip('/')}/data/batch={b}" for b in batches]
    packed = spark.read.schema(stream.schema).option("basePath", f"{store.rstrip('/')}/data").parquet(*paths).select(*stream.columns)
    # Spark lists a folder's files on the driver in any case; only names are compared
    # here (each holds a UUID; the path before it is spelled differently by the two sources)
    gone = {r["name"] for r in commits.select(F.element_at(F.split("file", "/"), -1).alias("name")).collect()}
    live = [f for f in stream.inputFiles() if f.rsplit("/", 1)[-1] not in gone]
    return packed.unionByName(spark.read.schema(stream.schema).parquet(*live)) if live else packed
