"""JDBC sink for the serving database.

``write_table`` replaces a table so that readers see either its old or its new
rows: the executors fill a staging table over ``num_partitions`` connections, and
one transaction on a connection of the driver then empties the table and
inserts the staged rows.  A failed partition, or a failed transaction, leaves the
old rows.  The number of rows comes from the write itself (observed, no second
``count()``) and must be the number inserted, so a task that wrote its rows twice
(retried after its commit) is noticed, not published.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@contextmanager
def transaction(spark: SparkSession, url: str, properties: Mapping[str, str]) -> Iterator:
    """A JDBC statement whose updates are committed together, or not at all."""
    jvm = spark._jvm
    info = jvm.java.util.Properties()
    for k, v in properties.items():
        info.setProperty(k, v)
    if "driver" in properties:  # loaded as Spark loads it, so jars given to the session count
        loaded = jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(properties["driver"])
        connection = loaded.newInstance().connect(url, info)
    else:
        connection = jvm.java.sql.DriverManager.getConnection(url, info)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        try:
            yield statement
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
    finally:
        connection.close()


def _fill(df: DataFrame, url: str, table: str, properties: Mapping[str, str], num_partitions: int | None) -> int:
    """Drops, creates and fills a table; returns the rows of the tasks that ended well."""
    seen = Observation()
    if num_partitions:
        df = df.coalesce(num_partitions)
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.jdbc(url=url, table=table, mode="overwrite", properties=dict(properties))
    return int(seen.get["rows"])


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    num_partitions: int | None = None,
    batch_size: int = 10_000,
    recreate: bool = False,
) -> int:
    """SNK-06: replace ``table`` by ``df`` and return its row count.

    A table that does not exist is created.  One whose columns differ raises;
    ``recreate`` drops it instead, which readers can see."""
    spark = df.sparkSession
    props = {"batchsize": str(batch_size), **(properties or {})}
    if recreate:
        return _fill(df, url, table, props, num_partitions)
    staging = f"{table}_staging"
    rows = _fill(df, url, staging, props, num_partitions)
    df.limit(0).write.jdbc(url=url, table=table, mode="append", properties=props)  # creates it where missing
    names = [c.lower() for c in read_table(spark, url, table, props).columns]
    if names != [c.lower() for c in df.columns]:
        raise ValueError(f"columns of {table} are {names}; use recreate to replace the table itself")
    with transaction(spark, url, props) as statement:
        statement.executeUpdate(f"DELETE FROM {table}")
        inserted = statement.executeUpdate(f"INSERT INTO {table} SELECT * FROM {staging}")
        if inserted != rows:
            raise RuntimeError(f"{table}: {inserted} rows staged, {rows} written")
        statement.executeUpdate(f"DROP TABLE {staging}")
    return rows


def publish(tables: Mapping[str, DataFrame], url: str, properties: Mapping[str, str] | None = None,
            **kwargs) -> dict[str, int]:
    """SNK-07: publish a set of tables; returns rows written per table."""
    return {name: write_table(df, url, name, properties, **kwargs) for name, df in tables.items()}


def read_table(spark, url: str, table: str, properties: Mapping[str, str] | None = None) -> DataFrame:
    return spark.read.jdbc(url=url, table=table, properties=dict(properties or {}))
