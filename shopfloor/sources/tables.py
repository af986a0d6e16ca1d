"""Batch Parquet sources (one folder of ``<name>.parquet`` tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class TableSet:
    """Lazily opened Parquet tables under one folder.

    Opening a table only reads its footer; Catalyst then prunes columns and
    pushes filters into each scan.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(self.path(name))
        return self._cache[name]


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
