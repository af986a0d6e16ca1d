"""Whitening of embeddings from exact, bit-sliced cross-products.

1. *Whole numbers.*  Every entry c becomes x = floor(256 * c), a long.  The fit
   list holds each distinct vector of these once (a grouping with partial aggregates,
   so a vector with a third of all rows is one row a task before the shuffle).
2. *Bit-sliced scatter.*  A task takes its rows in blocks, shifts each dimension to
   start at 0 and packs each bit of each dimension, across the rows, into 64-bit
   words.  The cross-product of two dimensions is the sum of the popcounts of
   the ANDs of their planes, weighted by 2**(a + b); undoing the shift gives the
   products of the x.  All of it is whole numbers, without a limit, so neither the order
   of rows nor the number of tasks changes a bit.
3. *Centred before the first rounding.*  With n vectors, sums S and products P the
   covariance is (n * P - S * S') / n**2: its numerator is a whole number and each
   entry is rounded once.  Its eigenvectors are the components.
4. *Check.*  A second pass over the fit list whitens it and measures the
   largest distance of its covariance from the identity.

What reaches the driver is one row per pair of dimensions.

Defined results: a vector that is null or holds null, NaN or infinite entries is left
out, as is one of another length than most have (ties: the shorter); rows that share
an id, or a vector, each keep their row; a null id stays null; an x beyond the ends
of a long is that end.  Components without variance (all
vectors equal, or fewer than a component needs) have null whitened values; with fewer
dimensions than components wanted there are as many as dimensions.  An empty
table, or one without usable vectors, gives an empty result.  Only the id and the
vector are read; other columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pin

SCALE, COMPONENTS = 256, 4
#: Rows that are packed together; words that are held at once.
BLOCK_ROWS, HELD_WORDS = 16_384, 1 << 20
_LIMB = 20
_LONG = pa.decimal128(38, 0)


@dataclass(frozen=True)
class Model:
    """Whole-number sums of the fit list and the components found from them."""

    n: int
    sums: tuple[int, ...]
    mean: np.ndarray
    components: np.ndarray  # a column each
    values: np.ndarray
    usable: np.ndarray  # components that have a variance
    explained: tuple[float, ...]
    identity_error: float | None = None

    def whitened(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return (x - self.mean) @ self.components / np.sqrt(np.where(self.usable, self.values, np.nan))


def whole_numbers(vectors: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The rows that take part, with ``x``, the vector in whole numbers, in place of ``column``."""
    c = F.col(column)
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    return vectors.where(F.coalesce(finite, F.lit(False))).withColumn("x", F.transform(c, lambda v: F.floor(v.cast("double") * scale))).drop(column)


def planes(u: np.ndarray) -> np.ndarray:
    """Bits of unsigned columns packed across rows: (bit, column, word)."""
    depth = max(1, int(u.max(initial=0)).bit_length())
    rows = -(-len(u) // 64) * 64
    out = np.zeros((depth, u.shape[1], rows // 64), np.uint64)
    for bit in range(depth):
        plane = np.zeros((u.shape[1], rows), np.uint8)
        plane[:, : len(u)] = ((u >> np.uint64(bit)) & np.uint64(1)).T
        out[bit] = np.packbits(plane, axis=1, bitorder="little").view(np.uint64)
    return out


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and cross-products (object arrays of int) of the columns of a block of longs."""
    rows, width = x.shape
    low = x.min(axis=0)
    sliced = planes(x.view(np.uint64) - low.view(np.uint64))  # a difference of longs fits the unsigned ones
    depth, _, words = sliced.shape
    total = np.zeros((width, width), object)
    step = max(1, HELD_WORDS // max(1, width * words))
    by_weight = np.zeros((2 * depth - 1, width, width), np.int64)
    for a in range(depth):
        for b in range(a, depth):
            counts = np.concatenate(
                [np.bitwise_count(sliced[a, i : i + step, None] & sliced[b, None]).sum(axis=2, dtype=np.int64) for i in range(0, width, step)]
            )
            by_weight[a + b] += counts if a == b else counts + counts.T
    for weight, counts in enumerate(by_weight):
        total += counts.astype(object) * (1 << weight)
    ones = np.bitwise_count(sliced).sum(axis=2, dtype=np.int64).astype(object)
    shifted = sum(ones[bit] * (1 << bit) for bit in range(depth))
    start = low.astype(object)
    sums = shifted + start * rows
    return sums, total + np.outer(start, shifted) + np.outer(shifted, start) + np.outer(start, start) * rows


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _scatter(listed: DataFrame, width: int) -> DataFrame:
    """Per pair of dimensions the exact cross-product, and per dimension (a = -1) the sum, as two decimals."""

    def run(batches):
        n, sums, products = 0, np.zeros(width, object), np.zeros((width, width), object)
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_ROWS):
                x = np.ascontiguousarray(_matrix(batch.column(0).slice(i, BLOCK_ROWS)))
                s, p = cross_products(x)
                n, sums, products = n + len(x), sums + s, products + p
        if not n:
            return
        found = [(-1, -1, n), *((-1, j, int(sums[j])) for j in range(width)), *((i, j, int(products[i, j])) for i in range(width) for j in range(i, width))]
        high = pa.array([v >> 64 for *_, v in found]).cast(_LONG) if all(-(2**63) <= v >> 64 < 2**63 for *_, v in found) else None
        if high is None:
            raise OverflowError("cross-products beyond 127 bits")
        low = _decimals([v & (2**64 - 1) for *_, v in found])
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int32()), high, low], names=["a", "b", "high", "low"])

    parts = listed.mapInArrow(run, "a int, b int, high decimal(38,0), low decimal(38,0)")
    return parts.groupBy("a", "b").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))


def _decimals(values: list[int | None]) -> pa.Array:
    from decimal import Decimal

    return pa.array([None if v is None or abs(v) >= 10**38 else Decimal(v) for v in values], _LONG)


def components(n: int, sums: list[int], products: dict[tuple[int, int], int], wanted: int) -> Model:
    """Eigenvectors of the covariance, from whole numbers."""
    width = len(sums)
    centred = {(i, j): n * p - sums[i] * sums[j] for (i, j), p in products.items()}
    covariance = np.array([[centred[min(i, j), max(i, j)] / n**2 for j in range(width)] for i in range(width)])
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:wanted]
    values, vectors = values[order], vectors[:, order]
    strongest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[strongest, np.arange(len(order))])
    trace = sum(centred[i, i] for i in range(width)) / n**2
    usable = values > max(width * np.finfo(float).eps * values.max(initial=0.0), 0.0)
    explained = tuple(float(v / trace) if trace else 0.0 for v in values)
    return Model(n, tuple(sums), np.array([s / n for s in sums]), vectors, values, usable, explained)


def _identity_error(listed: DataFrame, model: Model) -> float | None:
    """Largest entry of (covariance of the whitened fit list - identity) over the components that have a variance."""
    at = np.flatnonzero(model.usable)
    if not len(at):
        return None

    def run(batches):
        total = np.zeros((len(at), len(at)))
        for batch in batches:
            w = model.whitened(_matrix(batch.column(0)))[:, at]  # the mean is exact, so these are centred
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(at, len(at))), pa.array(np.tile(at, len(at))), pa.array(total.ravel())], names=["a", "b", "s"])

    rows = listed.mapInArrow(run, "a bigint, b bigint, s double").groupBy("a", "b").agg(F.sum("s").alias("s")).collect()
    return max(abs(r["s"] / model.n - (r["a"] == r["b"])) for r in rows)


def fit(rows: DataFrame, wanted: int = COMPONENTS) -> tuple[DataFrame, Model | None]:
    """The rows of the common length, and the model of their distinct vectors (None without rows)."""
    lengths = rows.groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("n")).where("width > 0")
    common = lengths.orderBy(F.col("n").desc(), "width").first()
    if common is None:
        return rows.limit(0), None
    width = int(common["width"])
    used = rows.where(F.size("x") == width)
    listed = pin(used.select("x").distinct(), "whitening-fit")
    found = {(r["a"], r["b"]): (int(r["high"]) << 64) + int(r["low"]) for r in _scatter(listed, width).collect()}
    n, sums = found.pop((-1, -1)), [found.pop((-1, j)) for j in range(width)]
    model = components(n, sums, found, wanted)
    return used, Model(**(model.__dict__ | {"identity_error": _identity_error(listed, model)}))


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int]:
    """Per row the exact sum of (n * x - S)**2: n**2 * xx - 2 n * xS + SS."""
    if np.abs(x.astype(np.float64)).max(initial=0.0) < 1 << 26 and x.shape[1] < 1 << 11:
        squares = (x * x).sum(axis=1).tolist()
        limbs = max(1, -(-max(abs(s) for s in sums).bit_length() // _LIMB))
        split = np.array([[(abs(s) >> (_LIMB * k) & ((1 << _LIMB) - 1)) * (1 if s >= 0 else -1) for k in range(limbs)] for s in sums], np.int64)
        mixed = [sum(v << (_LIMB * k) for k, v in enumerate(row)) for row in (x @ split).tolist()]
    else:
        wide = x.astype(object)
        squares, mixed = (wide * wide).sum(axis=1).tolist(), wide.dot(np.array(sums, object)).tolist()
    constant = sum(s * s for s in sums)
    return [n * n * q - 2 * n * m + constant for q, m in zip(squares, mixed, strict=True)]


def transform(rows: DataFrame, model: Model) -> DataFrame:
    """Adds ``deviation`` (decimal; null beyond 38 digits) and ``whitened`` (a number per component; null without variance) to rows with ``x``."""
    at = rows.columns.index("x")
    names = [c for c in rows.columns if c != "x"]
    k = len(model.values)
    kept = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(at)) if batch.num_rows else np.zeros((0, len(model.sums)), np.int64)
            flat = model.whitened(x).ravel()
            values = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, k), pa.int32()), pa.array(flat, mask=np.isnan(flat)))
            left = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*left, _decimals(deviations(x, model.n, model.sums)), values], names=[*names, "deviation", "whitened"])

    return rows.mapInArrow(run, f"{kept}, deviation decimal(38,0), whitened array<double>")


def whiten(vectors: DataFrame, column: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: the projection over the component's deviation, and the measures of the fit.

    ``deviation`` is null where a long cannot hold it; ``deviation_wide`` has 38 digits.
    """
    used, model = fit(whole_numbers(vectors.select("vec_id", column), column), wanted)
    if model is None:
        schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, deviation_wide decimal(38,0)"
        return vectors.sparkSession.createDataFrame([], schema)
    share = F.array(*[F.lit(v) for v in model.explained])
    each = transform(used, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        "whitened",
        share[F.col("at")].alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
        F.col("deviation").alias("deviation_wide"),
    )
