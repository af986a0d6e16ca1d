"""Raw sales lines from files (the spreadsheet export as CSV or Parquet).

Reads with the declared schema (no inference); the invoice date is parsed
as a wall-clock ``timestamp_ntz`` (independent of the session time zone),
and a bad date becomes null instead of failing the job under ANSI mode.
Ordering by date is not done here: every consumer that needs "first" uses
an aggregate over (date, tie-break) instead of a sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.operators.silver import wall_clock
from shopfloor.schemas import RAW_SALES

RAW_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_SALES.fields])


def read_raw_sales(spark: SparkSession, path: str, fmt: str = "csv", date_format: str | None = None) -> DataFrame:
    """Raw sales lines with typed columns.  CSV is read as text and cast with
    ``try_cast`` so one bad cell nulls that cell, not the job."""
    if fmt == "csv":
        df = spark.read.schema(RAW_TEXT).option("header", "true").csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    parsed = wall_clock(F.col("InvoiceDate").cast("string"), date_format)
    return df.select(
        F.col("Invoice").cast("string").alias("Invoice"),
        F.col("StockCode").cast("string").alias("StockCode"),
        F.col("Description").cast("string").alias("Description"),
        F.col("Quantity").cast("string").try_cast("int").alias("Quantity"),
        parsed.alias("InvoiceDate"),
        F.col("Price").cast("string").try_cast("double").alias("Price"),
        F.col("Customer ID").cast("string").try_cast("double").try_cast("long").alias("Customer ID"),
        F.col("Country").cast("string").alias("Country"),
    )
