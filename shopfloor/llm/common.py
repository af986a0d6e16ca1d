"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopfloor.session import pin

__all__ = ["pin", "table", "map_batches", "crc_mod", "hash_share", "prefix_sums", "connected_components", "mix64", "WORD", "partitions", "holds", "claim", "trim", "bound_batches", "text_parts"]

#: A word: a run of anything but the six ASCII white-space characters.
#: ``bytes.split()`` splits exactly so, and ``bytes.lower()`` lowers A-Z only.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(df: DataFrame) -> int:
    """The session's shuffle partition count (sized by the submitter to the data)."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


_held: dict[str, Callable[[], None]] = {}


def holds(name: str, drop: Callable[[], None]) -> None:
    """Says how to drop what an operator keeps in a Python worker between tasks."""
    _held[name] = drop


def trim() -> None:
    """Hands freed memory back to the system: Arrow's pool and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    if (give := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:  # not every C library has it
        give(0)


#: Bytes of an Arrow batch that Spark sends to a Python worker; by rows alone (10,000 of them) it grows with the texts' lengths.
BATCH_BYTES = 4_000_000


def bound_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches in bytes, in the executor and in its Python workers, unless the submitter has set a bound."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def claim(name: str) -> None:
    """At a task's start: what other operators have kept in this worker is dropped."""
    for other, drop in _held.items():
        if other != name:
            drop()
    trim()


def text_parts(batch: pa.RecordBatch, at: int, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows whose texts (column ``at``) hold about ``size`` bytes together."""
    if not batch.num_rows:
        yield batch
        return
    ends = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
    edge = np.flatnonzero(np.r_[True, np.diff(ends // size) != 0, True])
    for i, j in zip(edge[:-1], edge[1:], strict=True):
        yield batch.slice(int(i), int(j - i))


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus`` (null id: null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def hash_share(wanted: int, rows: int | Column) -> Column:
    """True for about twice ``wanted`` of ``rows`` rows, by the hash of doc_id, and for all
    rows where there are no more: a sample's sort then sees a bounded number of rows,
    however many tasks send some."""
    least = F.lit(float(2 * wanted)) / F.greatest(rows if isinstance(rows, Column) else F.lit(rows), F.lit(1))
    return F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < F.lit(float(1 << 40)) * least, F.lit(True))


def crc_mod_py(value, modulus: int) -> int | None:
    return None if value is None else zlib.crc32(str(value).encode()) % modulus


def mix64(x: np.ndarray, key: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix64 constants), vectorised over uint64."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64((key * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def prefix_sums(df: DataFrame, group: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all earlier rows of the row's group.

    Rows are ordered by (``bucket``, ``order``).  A group may hold a third of
    all rows, so no window spans one: bucket totals are summed first (one row a
    bucket), and the inner running sum stays within a bucket.
    """
    totals = df.groupBy(*group, bucket).agg(F.sum(value).alias("__total"))
    over = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group, bucket, F.coalesce(F.sum("__total").over(over), F.lit(0)).alias("__offset"))
    inner = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = df.withColumn("__inside", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return inside.join(offsets, [*group, bucket]).withColumn(out, F.col("__offset") + F.col("__inside")).drop("__offset", "__inside")


def connected_components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest id reachable, for every node of ``edges`` (a, b).

    Alternating large-star / small-star rounds: each round links the neighbours
    of a node to the smallest of them, so a star of any size shrinks without
    its rows ever meeting in one task (the minimum is a partial aggregate).
    Ends when a round changes nothing, which is read from (count, sum) of the
    round's table.  Every round is written to the shared folder, so the lineage
    stays short and a lost executor repeats only one round.
    """
    cur = pin(edges.select("a", "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-edges")
    seen = None
    for k in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = cur.join(least, "a").select(F.col("b").alias("x"), F.col("m"))  # b > a: its larger neighbours to the minimum
        large = large.unionByName(least.where("m < a").select(F.col("a").alias("x"), "m")).where("x <> m").distinct()
        low = large.groupBy("x").agg(F.min("m").alias("m2"))
        small = large.join(low, "x").select(F.col("m").alias("u"), F.col("m2").alias("v")).unionByName(low.select(F.col("x").alias("u"), F.col("m2").alias("v")))
        cur = pin(small.where("u <> v").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct(), f"{name}-round{k}")
        state = cur.agg(F.count(F.lit(1)), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return cur.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
