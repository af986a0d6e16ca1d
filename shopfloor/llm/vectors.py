"""Reading vector columns: which rows take part, and their float64 matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str = "embedding") -> Column:
    """True for vectors that are not null, empty or zero and hold only finite numbers."""
    c = F.col(column)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(c.isNotNull() & finite & F.exists(c, lambda x: x != 0), F.lit(False))


def packed(df: DataFrame, column: str, out: str = "vec") -> DataFrame:
    """Adds ``out``: the vector as the bytes of its float64 numbers."""
    at = df.columns.index(column)
    names = [c for c in df.columns if c != column]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != column)

    def run(batches):
        for batch in batches:
            rows = batch.column(at)
            flat = np.asarray(rows.flatten().to_numpy(zero_copy_only=False), np.float64)
            edge = np.asarray(rows.offsets) - rows.offsets[0].as_py()
            data = [flat[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*[c for i, c in enumerate(batch.columns) if i != at], pa.array(data, pa.binary())], names=[*names, out])

    return df.mapInArrow(run, f"{schema}, {out} binary")


def matrix(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)


def dots(rows: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products in double precision; equal rows give equal results to the last bit."""
    return np.einsum("ij,j->i", rows, v, optimize=False)
