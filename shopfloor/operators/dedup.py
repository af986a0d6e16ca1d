"""Deterministic de-duplication.

``keep_first`` keeps, per key, the row that is smallest under a total order
(the given order columns, then every remaining column).  It is a grouped
``min`` over a struct rather than a ``row_number`` window: the aggregate is
partially applied on the map side, so a key with millions of copies leaves
each task as one row, and no task ever holds a whole group.  Null keys are
equal to each other, as in ``dropDuplicates``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    keys, order = list(keys), [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    tie = order + rest
    if not tie:
        return df.select(*keys).distinct()
    best = F.min(F.struct(*[F.col(c) for c in tie])).alias("__best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*[F.col(c) if c in keys else F.col(f"__best.{c}").alias(c) for c in df.columns])


def keep_first_window(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The same result with a ``row_number`` window; for small inputs and as
    the baseline in tests."""
    from pyspark.sql import Window

    keys = list(keys)
    tie = [c for c in order if c not in keys] + [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in tie])
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
