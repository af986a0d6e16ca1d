"""The order-line fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.functions.periods import date_key
from shopfloor.operators.events import ORDER_CANCELLED
from shopfloor.schemas import FACT_COLUMNS


def fact_order_items(silver_orders: DataFrame) -> DataFrame:
    """One row per silver order line: date key, cancel flag (a null event
    type counts as a sale), absolute quantity and amount, lineage times.
    Projection only: no shuffle."""
    return silver_orders.select(
        "invoice_id",
        "stock_code",
        F.col("customer_id").cast("string").alias("customer_id"),
        "country",
        date_key("event_time").alias("date_key"),
        "year",
        "month",
        F.abs("quantity").alias("quantity"),
        "unit_price",
        F.abs("total_amount").alias("total_amount"),
        F.coalesce(F.col("event_type") == ORDER_CANCELLED, F.lit(False)).alias("is_cancelled"),
        "event_time",
        "kafka_timestamp",
        "bronze_ingestion_time",
        "silver_ingestion_time",
    ).select(*FACT_COLUMNS)
